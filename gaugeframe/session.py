"""Session settings the library expects, and small frames built from configuration."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

RECOMMENDED_CONF = {
    # Timestamps are naive UTC everywhere (see functions.timestamps).
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Re-writing one run replaces only that run's partition (see sources.marts).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Plans are built from many columns; recording a call site for each doubles that time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder."""
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


def local_frame(
    spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType
) -> DataFrame:
    """A DataFrame from configuration rows.

    Going through Arrow gives Catalyst a LocalRelation whose exact size it knows, so joins
    against it are broadcast only when that size is below the session's threshold.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    dicts = [dict(zip(names, row)) for row in rows]
    table = pa.Table.from_pylist(dicts, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)
