"""URL filters: rules by host and path, and a classifier for all other URLs.

Rules decide first; the longest rule that fits wins. All other URLs are judged by multinomial
naive Bayes over the words of the host and the path, trained on the URLs that rules decide.

Hosts run words together. Each host label is segmented by a unigram Viterbi search over words
and counts from the texts of all pages. Only words that occur in some host label matter, so the
counts are joined with the labels' substrings, as tables; nothing of the vocabulary is
broadcast. Classifier weights are hashed into a fixed number of buckets, and these go to tasks.

Defined results: a null url, or one without `://`, has an empty host and path and fits no rule.
Without URLs of both verdicts to learn from, the verdict is that of the known ones, else allow.
Ties go to allow. Null html counts no words. Repeated rows count as often as they occur; other
columns play no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.common import stored

# (verdict, rule); a rule is a host, then a path.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)


@dataclass(frozen=True)
class UrlOptions:
    rules: tuple[tuple[str, str], ...] = RULES
    buckets: int = 1 << 14
    smoothing: float = 1.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    after = F.substr(url, F.locate("://", url) + 3)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(after, r"(?s)^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return tuple(F.when(found, x).otherwise("") for x in (host, path))


def deciding_rule(host: Column, path: Column, o: UrlOptions) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(o.rules, key=lambda r: (len(r[1]), r[1])):
        name, _, tail = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{tail}")
        out = F.when(fits, rule).otherwise(out)
    return out


# ---------------------------------------------------------------- segmentation


def viterbi(label: str, cost: dict[str, float], unknown: float) -> list[str]:
    """The cheapest split into words of known cost; other characters cost `unknown` each.

    Among equal costs the longest last word wins. Neighbouring unknown characters are one word.
    """
    best = [(0.0, 0, True)]
    longest = max(map(len, cost), default=1)
    for end in range(1, len(label) + 1):
        options = [(best[end - 1][0] + unknown, end - 1, False)]
        for start in range(max(0, end - longest), end):
            c = cost.get(label[start:end])
            if c is not None:
                options.append((best[start][0] + c, start, True))
        best.append(min(options, key=lambda x: (x[0], x[1])))
    words, end, open_ = [], len(label), False
    while end:
        _, start, known = best[end]
        if not known and open_:
            words[-1] = label[start:end] + words[-1]
        else:
            words.append(label[start:end])
        open_, end = not known, start
    return words[::-1]


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) over the visible text of all pages."""
    text = F.lower(F.regexp_replace(F.col("html").cast("string"), "(?s)<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word")).where("word != ''")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def segmented_hosts(hosts: DataFrame, pages: DataFrame, o: UrlOptions) -> DataFrame:
    """(host, words) for every different host."""
    labels = hosts.select("host").distinct().select(
        "host", F.posexplode(F.split("host", "[.:]")).alias("at", "label")
    ).withColumn("part", F.explode(F.split("label", r"[^\p{L}]+")))
    counts = stored(word_counts(pages), "word-counts")
    # No piece longer than the longest word that a label of a host can hold (63 letters by DNS)
    # or that the texts have is worth a look.
    longest = counts.where(F.length("word") <= 63).agg(F.max(F.length("word"))).first()[0] or 1
    parts = stored(labels.select("part").where("part != ''").distinct(), "host-parts")
    pieces = parts.select(
        "part", F.explode(F.sequence(F.lit(1), F.length("part"))).alias("i")
    ).select(
        "part",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(F.lit(longest), F.length("part") - F.col("i") + 1)),
                lambda n: F.substr(F.col("part"), F.col("i"), n),
            )
        ).alias("word"),
    ).distinct()
    total = counts.agg(F.sum("n")).first()[0] or 1
    known = (
        pieces.join(counts, "word")
        .groupBy("part").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    )
    unknown = math.log(total) + math.log(10)

    @F.udf("array<string>")
    def split(part: str, known: list | None) -> list[str]:
        cost = {w: math.log(total / n) for w, n in known or ()}
        return viterbi(part, cost, unknown)

    words = parts.join(known, "part", "left").select("part", split("part", "known").alias("words"))
    return (
        labels.join(words, "part")
        .groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words"))
        .select("host", F.sort_array("words").alias("words"))
    )


# ---------------------------------------------------------------- the classifier


def _weights(known: DataFrame, o: UrlOptions) -> tuple[np.ndarray, float]:
    """Log-odds of block against allow per bucket, and the prior's, from (verdict, buckets)."""
    sums = (
        known.select("verdict", F.explode(F.concat(F.array(F.lit(-1)), "buckets")).alias("bucket"))
        .groupBy("verdict", "bucket").count()
    )
    counts = {v: np.zeros(o.buckets) for v in ("allow", "block")}
    rows = dict.fromkeys(counts, 0)
    for verdict, bucket, n in sums.collect():  # at most 2 x (buckets + 1) rows
        if bucket < 0:
            rows[verdict] = n
        else:
            counts[verdict][bucket] = n
    if not all(rows.values()):
        return np.zeros(o.buckets), 1.0 if rows["block"] else -1.0
    share = {v: np.log((c + o.smoothing) / (c.sum() + o.smoothing * o.buckets)) for v, c in counts.items()}
    return share["block"] - share["allow"], math.log(rows["block"] / rows["allow"])


def judge(pages: DataFrame, o: UrlOptions = UrlOptions()) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) of every row."""
    host, path = host_and_path(F.col("url").cast("string"))
    verdict_of = F.lit(None).cast("string")
    for verdict, rule in o.rules:
        verdict_of = F.when(F.col("rule") == rule, verdict).otherwise(verdict_of)
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path")).withColumn(
        "rule", deciding_rule(F.col("host"), F.col("path"), o)
    ).withColumn("verdict", verdict_of)
    hosts = stored(urls.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    words = stored(segmented_hosts(hosts, pages, o), "host-words")
    # Runs of digits say nothing but that there is a number.
    tail = F.regexp_replace(F.lower("path"), "[0-9]+", "0")
    path_words = F.array_remove(F.split(tail, r"[^\p{L}0-9]+"), "")
    tokens = F.concat(
        F.transform(F.coalesce("words", F.array()), lambda w: F.concat(F.lit("h:"), w)),
        F.transform(path_words, lambda w: F.concat(F.lit("p:"), w)),
    )
    hashed = stored(
        urls.join(words, "host", "left").withColumn(
            "buckets",
            F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(o.buckets)).cast("int")),
        ).drop("words"),
        "url-tokens",
    )
    weights, prior = _weights(hashed.where("verdict IS NOT NULL").select("verdict", "buckets"), o)
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(buckets: pd.Series) -> pd.Series:
        held = shared.value
        return pd.Series([prior + float(held[np.asarray(b, int)].sum()) for b in buckets])

    return hashed.withColumn("block_score", score("buckets")).select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("block_score") > 0, "block").otherwise("allow")).alias("verdict"),
        "block_score",
    )
