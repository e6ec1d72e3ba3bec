"""Personal data: base patterns, wider candidate generators and boosted trees that choose.

Base spans are what four patterns find and a validity check confirms; they always stay. The
generators propose spans that look similar (other separators, spelled-out signs, wrong check
digits) and may overlap. Boosted trees score each proposal by its format and its context. They
learn from all proposals of all texts: those that meet a base span of their kind are positive.
Per kind, the lowest threshold is taken at which the chosen proposals reach the wanted
precision; proposals at or above it that touch no base span become further spans.

Only SQL functions run on the rows. Training counts feature combinations over all rows; their
number is bounded by the features (see `MAX_COMBINATIONS`), and only these counts reach the
driver.

Defined results: a null text is empty and has no spans. Offsets count code points, ends are
exclusive. Repeated rows get equal results; other columns play no part. Without proposals, or
in an empty table, nothing is added. Patterns are written so that no text makes them backtrack
more than linearly or recurse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm import boosting
from gaugeframe.llm.common import let, text_of

KINDS = ("email", "ip", "card", "phone")

# Possessive forms of the base patterns. They match the same spans: a match can only begin
# where the run of its first class begins, or where the match before ended (\G).
BASE = {
    "email": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What must occur in a text for the kind's patterns to be tried at all.
NEEDS = {"email": r"(?i)@|\(at\)|\[at\]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
# Wider proposals: any sign for @ and dot; groups of hexadecimal digits or numbers; digits in
# groups with any separator; numbers in groups without a plus sign. All are bounded.
PROPOSALS = {
    "email": (
        r"(?i)(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?"
        r"[\p{L}0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[\p{L}0-9-]{1,63}+){0,8}"
    ),
    "ip": r"(?<![0-9.:])(?:[0-9]{1,3}+(?:\.[0-9]{1,3}+){3,5}|[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){5,7})",
    "card": r"(?<![0-9])[0-9]{3,4}+(?:[\x20./_-]{0,2}[0-9]{2,6}+){2,5}",
    "phone": r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}+\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}+\)?){2,5}",
}
CONTEXT = 16
HINTS = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|server|address",
    "card": r"(?i)card|visa|credit|account|payment",
    "phone": r"(?i)tel|phone|call|fax|mobile|contact",
}
# Each feature's number of values.
FEATURES = {"kind": 4, "digits": 8, "groups": 6, "signs": 5, "before": 5, "after": 5, "hint": 2}
MAX_COMBINATIONS = 4 * 8 * 6 * 5 * 5 * 5 * 2


@dataclass(frozen=True)
class PiiModel:
    trees: boosting.Boosted
    # Log-odds from which a proposal of the kind is chosen; None if none ever is.
    thresholds: dict[str, float | None]


# ---------------------------------------------------------------- matches with offsets


def matches(text: Column, pattern: str, needs: str) -> Column:
    """All matches as an array of (s, e, v, before, after), by offset.

    The pieces between the matches and the matches alternate, so running lengths are offsets.
    The running sum goes block by block: appending to one long array would copy it every time.
    """
    element = "struct<s:bigint,e:bigint,v:string,before:string,after:string>"
    block = 128

    def place(parts: Column, found: Column) -> Column:
        def one(acc: Column, i: Column) -> Column:
            before, value = F.get(parts, i), F.get(found, i)
            start = acc["off"] + F.length(before)
            end = start + F.length(value)
            item = F.struct(
                start.alias("s"), end.alias("e"), value.alias("v"),
                F.right(before, F.lit(CONTEXT)).alias("before"),
                F.left(F.get(parts, i + 1), F.lit(CONTEXT)).alias("after"),
            )
            return F.struct(
                end.alias("off"), F.array_append(acc["out"], item).alias("out")
            )

        def start_at(off: Column, kind: str) -> Column:
            return F.struct(
                off.cast("bigint").alias("off"), F.array().cast(f"array<{kind}>").alias("out")
            )

        def one_block(acc: Column, first: Column) -> Column:
            inner = F.aggregate(
                F.sequence(first, F.least(first + block, F.size(found)) - 1),
                start_at(acc["off"], element), one,
            )
            return let(
                inner,
                lambda x: F.struct(
                    x["off"].alias("off"), F.array_append(acc["out"], x["out"]).alias("out")
                ),
            )

        return F.flatten(
            F.aggregate(
                F.sequence(F.lit(0), F.size(found) - 1, F.lit(block)),
                start_at(F.lit(0), f"array<{element}>"), one_block, lambda acc: acc["out"],
            )
        )

    empty = F.array().cast(f"array<{element}>")
    return F.when(
        text.rlike(needs),
        let(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda found: F.when(F.size(found) == 0, empty).otherwise(
                let(F.split(text, pattern, -1), lambda parts: place(parts, found))
            ),
        ),
    ).otherwise(empty)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check."""

    def term(i: Column) -> Column:
        d = F.ascii(F.substr(digits, F.length(digits) - i, F.lit(1))) - 48
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    total = F.aggregate(
        F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + term(i)
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return let(digits, lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(matches(text, BASE[kind], NEEDS[kind]), lambda m: _valid(kind, m["v"]))


def _char_class(text: Column) -> Column:
    """Of one neighbouring character: 0 none, 1 white space, 2 letter, 3 digit, 4 other."""
    return (
        F.when(text == "", 0)
        .when(text.rlike(r"^\s$"), 1)
        .when(text.rlike(r"^\p{L}$"), 2)
        .when(text.rlike("^[0-9]$"), 3)
        .otherwise(4)
    )


def _features(kind: str, m: Column) -> dict[str, Column]:
    """Format and context of a proposal. None tells whether a base check accepts it."""
    value = m["v"]
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    signs = (
        F.when(value.rlike(r"[\[(](?i:at|dot)[\])]"), 4)
        .when(value.rlike(r"[/_:]"), 3)
        .when(value.rlike(r"[()]"), 2)
        .when(value.rlike(r"[\x20.-]"), 1)
        .otherwise(0)
    )
    return {
        "kind": F.lit(KINDS.index(kind)),
        "digits": F.least(F.floor(digits / 3), F.lit(7)).cast("int"),
        "groups": F.least(F.size(F.split(value, "[^\\p{L}0-9]+")) - 1, F.lit(5)),
        "signs": signs,
        "before": _char_class(F.right(m["before"], F.lit(1))),
        "after": _char_class(F.left(m["after"], F.lit(1))),
        "hint": m["before"].rlike(HINTS[kind]).cast("int"),
    }


def _touches(m: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"]))


def _with_spans(docs: DataFrame, text: str) -> DataFrame:
    """Adds `_base` (a struct of an array per kind) and `_seen` (proposals with features)."""
    body = text_of(text)
    out = docs.withColumn(
        "_base", F.struct(*[base_spans(body, k).alias(k) for k in KINDS])
    )

    def seen(kind: str) -> Column:
        base = F.col(f"_base.{kind}")
        return let(
            base,
            lambda b: F.transform(
                matches(body, PROPOSALS[kind], NEEDS[kind]),
                lambda m: F.struct(
                    m["s"].alias("s"), m["e"].alias("e"),
                    F.struct(
                        *[c.cast("int").alias(n) for n, c in _features(kind, m).items()],
                        _touches(m, b).cast("int").alias("positive"),
                    ).alias("f"),
                ),
            ),
        )

    return out.withColumn("_seen", F.concat(*[seen(k) for k in KINDS]))


# ---------------------------------------------------------------- the model


def fit(docs: DataFrame, text: str = "text", precision: float = 0.95) -> PiiModel:
    """Trees and thresholds from the proposals of all rows.

    `precision` is the share of chosen proposals of a kind that must meet base spans.
    """
    # The whole struct is the key: taking it apart would evaluate the patterns once per field.
    counts = (
        _with_spans(docs.select(text), text)
        .select(F.explode_outer(F.transform("_seen", lambda m: m["f"])).alias("f"))
        .groupBy("f").count()
    )
    table: dict[tuple, list[int]] = {}
    for r in counts.where("f IS NOT NULL").collect():
        cell = table.setdefault(tuple(r["f"][n] for n in FEATURES), [0, 0])
        cell[0] += r["count"]
        cell[1] += r["count"] * r["f"]["positive"]
    rows = [
        dict(zip(FEATURES, key), total=total, positive=positive)
        for key, (total, positive) in sorted(table.items())
    ]
    if not rows:
        return PiiModel(boosting.Boosted(0.0, ()), dict.fromkeys(KINDS))
    trees = boosting.fit(rows, tuple(FEATURES))
    thresholds: dict[str, float | None] = {}
    for index, kind in enumerate(KINDS):
        scored = sorted(
            ((trees.score(r), r) for r in rows if r["kind"] == index), key=lambda x: -x[0]
        )
        chosen, good, best = 0, 0, None
        for i, (score, r) in enumerate(scored):
            chosen, good = chosen + r["total"], good + r["positive"]
            last_of_score = i + 1 == len(scored) or scored[i + 1][0] < score
            # The midpoint keeps rounding of equal sums on one side.
            if last_of_score and good >= precision * chosen:
                below = scored[i + 1][0] if i + 1 < len(scored) else score - 1.0
                best = (score + below) / 2
        thresholds[kind] = best
    return PiiModel(trees, thresholds)


def find(docs: DataFrame, model: PiiModel, text: str = "text", prefix: str = "pii_") -> DataFrame:
    """All columns of `docs`, the base spans of each kind and all spans.

    `<prefix>base` is a struct with an array of (s, e, ...) per kind; `<prefix>spans` an array
    of (kind, s, e) by kind as listed, then start; columns of these names are replaced. Proposals that are chosen and overlap each
    other both appear; redaction merges them.
    """
    columns = docs.columns
    held = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")
    found = _with_spans(docs.select(held, F.col(text).alias("_text")), "_text")

    def added(kind: str) -> Column:
        threshold = model.thresholds.get(kind)
        if threshold is None:
            return F.array().cast("array<struct<s:bigint,e:bigint>>")
        index = KINDS.index(kind)
        picked = F.filter(
            F.col("_seen"),
            lambda m: (m["f"]["kind"] == index)
            & (model.trees.score_column({n: m["f"][n] for n in FEATURES}) >= threshold),
        )
        all_base = F.concat(*[F.col(f"_base.{k}") for k in KINDS])
        free = let(all_base, lambda b: F.filter(picked, lambda m: ~_touches(m, b)))
        return F.transform(free, lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e")))

    def spans(kind: str) -> Column:
        own = F.transform(
            F.col(f"_base.{kind}"), lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"))
        )
        return _named(kind, F.sort_array(F.concat(own, added(kind))))

    new = {f"{prefix}base": F.col("_base"), f"{prefix}spans": F.concat(*[spans(k) for k in KINDS])}
    return found.select(
        *[F.col("_row").getField(c).alias(c) for c in columns if c not in new],
        *[c.alias(name) for name, c in new.items()],
    )


def _named(kind: str, spans: Column) -> Column:
    return F.transform(
        spans, lambda m: F.struct(F.lit(kind).alias("kind"), m["s"].alias("s"), m["e"].alias("e"))
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["s"], m["e"])), ","
    )


def digest(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """Per document: numbers of base spans, their hash, and all spans as one text."""
    docs = docs.select("doc_id", "text")
    found = find(docs, model or fit(docs))
    base = F.concat(*[_named(k, F.col(f"pii_base.{k}")) for k in KINDS])
    return found.select(
        "doc_id",
        *[F.size(F.col(f"pii_base.{k}")).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("pii_spans")).alias("spans"),
    )


def redact(docs: DataFrame, model: PiiModel, text: str = "text") -> DataFrame:
    """The columns of `docs`, with every span of the text replaced by its kind, as `[EMAIL]`.

    Overlapping spans become one replacement, named after the first. A null text stays null.
    """
    columns = docs.columns
    held = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    found = find(docs.select(held, F.col(text).alias("text")), model)
    body = F.col("text")
    by_start = F.sort_array(
        F.transform(
            F.col("pii_spans"),
            lambda m: F.struct(m["s"].alias("s"), (-m["e"]).alias("e"), m["kind"].alias("kind")),
        )
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        end = -m["e"]
        gap = F.substr(body, (acc["at"] + 1).cast("int"), (m["s"] - acc["at"]).cast("int"))
        return F.when(
            m["s"] >= acc["at"],
            F.struct(
                end.alias("at"),
                F.concat(acc["out"], gap, F.lit("["), F.upper(m["kind"]), F.lit("]")).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(acc["at"], end).alias("at"), acc["out"].alias("out")))

    redacted = F.aggregate(
        by_start, start, step,
        lambda acc: F.concat(acc["out"], F.substr(body, (acc["at"] + 1).cast("int"))),
    )
    clean = F.when(F.size("pii_spans") > 0, redacted).otherwise(body)
    return found.select(
        *[(clean if c == text else F.col("row").getField(c)).alias(c) for c in columns]
    )
