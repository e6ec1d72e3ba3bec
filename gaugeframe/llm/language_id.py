"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of all labelled texts; each task adds up its own rows first, so
at most (languages x buckets) sums per task are shuffled. The log-probability matrix has
`buckets` columns and a row per language, is checked against `max_languages`, and goes to all
tasks. Scoring turns a batch of texts into one sparse vector per text in numpy.

Defined results: a text that is null or has no letter is `und` with score 0. Labels that are
null train nothing; without any usable label, every text is `und`. Ties go to the smaller
label. Whole texts count, piece by piece, so that memory does not grow with a text's length.
Repeated rows count as often as they occur; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
_PIECE = 1 << 18


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray  # (languages, buckets)
    orders: tuple[int, ...]


def _codes(text: str) -> np.ndarray:
    lowered = " " + text.lower() + " "
    return np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashed(codes: np.ndarray, orders: tuple[int, ...], buckets: int) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams that begin in each piece of a text."""
    longest = max(orders)
    for start in range(0, len(codes), _PIECE):
        piece = codes[start : start + _PIECE + longest - 1].astype(np.uint32)
        rolled = np.zeros(len(piece), np.uint32)
        for n in range(1, longest + 1):
            rolled = rolled[: len(piece) - n + 1] * np.uint32(0x01000193) ^ piece[n - 1 :]
            if len(rolled) == 0:
                break
            if n in orders:
                mixed = (rolled ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                mixed ^= mixed >> np.uint32(15)
                yield mixed[:_PIECE] & np.uint32(buckets - 1)


def gram_counts(text: str, orders: tuple[int, ...], buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for grams in _hashed(_codes(text), orders, buckets):
        out += np.bincount(grams, minlength=buckets)
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(
    docs: DataFrame, label: str = "lang", text: str = "text", orders: tuple[int, ...] = (1, 2, 3),
    buckets: int = 1 << 14, max_languages: int = 512, smoothing: float = 0.5,
) -> LanguageModel:
    """A model from all rows of `docs` with a label and a text with a letter.

    At most `max_languages` labels are supported; more are an error, as the matrix that every
    task receives has languages x buckets cells.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for pdf in batches:
            for name, body in zip(pdf["label"], pdf["text"]):
                if not has_letter(body):
                    continue
                if name not in sums:
                    sums[name], rows[name] = np.zeros(buckets, np.int64), 0
                rows[name] += 1
                held = sums[name]
                for grams in _hashed(_codes(body), orders, buckets):
                    # Short pieces touch few buckets, long ones many.
                    if len(grams) < buckets // 4:
                        np.add.at(held, grams, 1)
                    else:
                        held += np.bincount(grams, minlength=buckets)
        for name, held in sums.items():
            at = np.flatnonzero(held)
            yield pd.DataFrame({"label": name, "bucket": at, "n": held[at]})
            yield pd.DataFrame({"label": [name], "bucket": [-1], "n": [rows[name]]})

    labelled = docs.select(
        F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text")
    ).where("label IS NOT NULL AND text IS NOT NULL")
    sums = (
        labelled.mapInPandas(count, "label string, bucket int, n long")
        .groupBy("label", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
        .limit(max_languages + 1)
    )
    found = sorted(sums.collect(), key=lambda r: r["label"])
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} labels")
    counts = np.zeros((len(found), buckets))
    rows = np.zeros(len(found))
    for i, r in enumerate(found):
        for bucket, n in r["cells"]:
            if bucket < 0:
                rows[i] = n
            else:
                counts[i, bucket] = n
    smooth = counts + smoothing
    return LanguageModel(
        tuple(r["label"] for r in found),
        np.log(rows / max(rows.sum(), 1)) if len(found) else rows,
        np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True)),
        orders,
    )


def score_text(text: str | None, model: LanguageModel) -> tuple[str, float]:
    """The best label, and the share it would have among all at the mean gram's evidence.

    The posterior of long texts is 1 for whatever leads, so the log-likelihoods are divided by
    the square root of the number of n-grams before they become shares.
    """
    if text is None or not model.labels or not has_letter(text):
        return UNKNOWN, 0.0
    total, n = model.log_prior.copy(), 0
    for grams in _hashed(_codes(text), model.orders, model.log_prob.shape[1]):
        at, times = np.unique(grams, return_counts=True)
        total = total + model.log_prob[:, at] @ times
        n += len(grams)
    best = int(np.argmax(total))
    share = np.exp((total - total[best]) / np.sqrt(n))
    return model.labels[best], float(1.0 / share.sum())


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All columns of `docs` with `lang_pred` and `score`, columns of these names replaced."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def best(texts: pd.Series) -> pd.DataFrame:
        scored = [score_text(t, shared.value) for t in texts]
        return pd.DataFrame(scored, columns=["lang_pred", "score"])

    out = docs.withColumn("_best", best(F.col(text).cast("string")))
    return out.withColumns(
        {"lang_pred": F.col("_best.lang_pred"), "score": F.col("_best.score")}
    ).drop("_best")


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that train nothing. A row without id has no remainder and is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def digest(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )
