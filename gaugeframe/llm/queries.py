"""The registered queries of this subpackage, each a callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeframe.llm import (
    decontamination, extraction, hard_negatives, language_id, lexical_search, mixing, near_dedup,
    packing, pii, quality, topk_search, url_filter, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of personal data, and all spans that the boosted trees choose."""
    return pii.digest(table(spark, sf_dir, "documents"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of line-first cleaning for every document."""
    return quality.digest(table(spark, sf_dir, "documents"))


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over four-word shingles."""
    return near_dedup.near_duplicates(
        table(spark, sf_dir, "documents"), near_dedup.NearDup(shingle=4)
    )


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from two thirds of the labels."""
    return language_id.digest(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into bins of 2048 words; equal texts never share a bin."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all sources takes."""
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to WARC archives and read back in byte ranges."""
    return warc.digest(table(spark, sf_dir, "pages"))


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page URLs, by rule or else by naive Bayes over segmented words."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector over all others."""
    return topk_search.digest(table(spark, sf_dir, "embeddings"))


@query
def op5_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extraction.extract(table(spark, sf_dir, "pages"))


@query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a ten-word window of a benchmark item."""
    return decontamination.digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth vector."""
    return hard_negatives.digest(table(spark, sf_dir, "embeddings"))


@query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return lexical_search.ranked(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
