"""What several operators share: words, shared scratch tables, and small column helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are separated by these characters only: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def text_of(column: str) -> Column:
    """The column as text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, however often the body names it.

    Inside a lambda, an outer expression is evaluated for every element; a lambda's own
    argument is not. The one-element array turns the value into such an argument.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Where none is set, a session on one machine, as in tests, gets a temporary one. On a cluster
    that is an error, as each executor would write to a disk of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="gaugeframe-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts the lineage: a lost executor costs its own tasks, not the whole plan. As the table is
    then a bare scan of known size, joins on it are broadcast only below the session's
    threshold, and a join on a hot key can be split by the adaptive skew join.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
