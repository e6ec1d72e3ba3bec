"""A training-corpus pipeline over `documents`: five stages, each written and read again.

All stages but the last return the columns of their input; the last returns packed pieces.
Null or empty texts do not pass the first stage. In an empty table every stage is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeframe.llm import mixing, near_dedup, packing, pii, quality
from gaugeframe.llm.common import stored


def _packed(docs: DataFrame, *more: Column) -> DataFrame:
    """The rows of `docs` as one struct `row`, so that none of their names meets a working column."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), F.col("text"), *more)


def _with_text(row: Column, text: Column) -> Column:
    return row.withField("text", text).withField("n_chars", F.length(text).cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without notices and other failing lines; the rest is as it was."""
    rules = quality.QualityRules(notices_only=True)
    judged = quality.clean_lines(_packed(docs), rules=rules).where("q_kept")
    return judged.select(_with_text(F.col("row"), F.col("q_clean_text")).alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id.

    A row without id stays only if its group has no id; of rows that share the id, the first by
    a hash of the text. Texts without words are no duplicates and stay.
    """
    rows = near_dedup.grouped_rows(docs)
    place = F.struct(F.col("doc").isNull().alias("unnamed"), F.coalesce("doc", F.lit(0).cast("long")).alias("doc"), "t1", "t2")
    kept = stored(
        rows.where("n > 0").groupBy("root").agg(F.min(place).alias("row")).select("row.*"), "kept"
    )
    ends = ["unnamed", "doc", "t1", "t2"]
    doc = F.col("doc_id").cast("long")
    placed = _packed(
        docs, doc.isNull().alias("unnamed"), F.coalesce(doc, F.lit(0).cast("long")).alias("doc"),
        *near_dedup.text_keys("text"),
    )
    first = Window.partitionBy(*ends).orderBy(F.xxhash64("row"))
    named = (
        placed.join(kept, ends, "left_semi")
        .withColumn("place", F.row_number().over(first)).where("place = 1")
    )
    wordless = ~F.coalesce(F.col("text").rlike(quality.HAS_WORD), F.lit(False))
    return named.select("row.*").union(docs.where(wordless))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    redacted = pii.redact(_packed(docs), pii.fit(docs.select("text")))
    return redacted.select(_with_text(F.col("row"), F.col("text")).alias("row")).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it: never, once or twice."""
    return mixing.repeated(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in bins; the two copies of a document never share one."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_bins", pack_bins),
]

# The third stage uses a trained model and the fourth a seeded hash; SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
