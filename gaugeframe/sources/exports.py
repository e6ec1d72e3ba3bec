"""Raw CSV exports and staged Parquet tables (IO1-IO3, IO9, IO11)."""

from __future__ import annotations

import csv
import io
import json
import time
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.config import Vocabulary
from gaugeframe.operators.cleaning import TABLES, Cleaner, clean_all
from gaugeframe.sources.marts import path_exists


def first_lines(spark: SparkSession, path: str, multi_line: bool = False) -> dict[str, list[str]]:
    """IO1: the header line of every non-empty text file under `path`, with the files it heads.

    One job, whatever the number of files: each file is one task, which stops after the first
    lines. A quoted name may span lines. What comes back is one row per file, as the driver's
    own listing has.
    """
    # A session of its own, as these settings would change how other scans are split.
    scan = spark.newSession()
    whole_files = str(2**61)
    scan.conf.set("spark.sql.files.maxPartitionBytes", whole_files)
    scan.conf.set("spark.sql.files.openCostInBytes", whole_files)
    scan.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")

    def head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines: list[str] = []
        for batch in batches:
            for line in batch["value"]:
                # The multi-line reader takes a line of spaces for a header.
                if lines or (line if multi_line else line.strip()):
                    lines.append(line)
                if lines and sum(x.count('"') for x in lines) % 2 == 0:
                    yield pd.DataFrame({"file": [batch["file"].iloc[0]], "header": ["\n".join(lines)]})
                    return

    files: dict[str, list[str]] = defaultdict(list)
    texts = scan.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    for r in texts.mapInPandas(head, "file string, header string").collect():
        files[r["header"]].append(unquote(r["file"]))
    return dict(files)


def _header_schema(header: str, wanted: Sequence[str]) -> T.StructType:
    """Text columns named as in the header; names that nobody wants, or that repeat, by place."""
    found = {name.lower(): name for name in reversed(wanted)}
    fields = []
    for i, name in enumerate(next(csv.reader(io.StringIO(header)))):
        fields.append(T.StructField(found.pop(name.strip().lower(), f"_{i}"), T.StringType()))
    if found:
        raise ValueError(f"No column {', '.join(sorted(found.values()))} in a file headed {header!r}")
    return T.StructType(fields)


def read_export(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool = False
) -> DataFrame:
    """IO1: a CSV file with a header, or a folder of them. Everything is text; cleaning decides
    the types.

    Columns are found by name, in whatever order each file has them: files with equal headers
    are read together, by a schema made from the header, so reading starts no further job.
    Files are split among tasks unless `multi_line` says that quoted fields may hold line breaks.
    """
    reader = spark.read.options(header=True, mode="PERMISSIVE", escape='"', multiLine=multi_line)
    parts = [
        reader.schema(_header_schema(header, columns)).csv(files).select(*columns)
        for header, files in sorted(first_lines(spark, path, multi_line).items())
    ]
    if not parts:
        raise ValueError(f"No file with a header under {path}")
    return reduce(DataFrame.union, parts)


def read_exports(
    spark: SparkSession,
    folder: str,
    tables: Mapping[str, Mapping[str, Cleaner]] = TABLES,
) -> dict[str, DataFrame]:
    return {
        name: read_export(spark, f"{folder}/{name}.csv", list(columns))
        for name, columns in tables.items()
    }


def write_staged(df: DataFrame, path: str, force: bool = False) -> None:
    """IO3: an existing target is an error unless `force`."""
    df.write.mode("overwrite" if force else "errorifexists").parquet(path)


def staged_names(spark: SparkSession, folder: str) -> list[str]:
    """IO11: the tables that a stage folder holds, whatever they are called."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    entries = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    names = [e.getPath().getName() for e in entries if e.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")) and n != _METADATA)


def read_staged(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The named tables of a stage folder, by default all that it holds."""
    found = names if names is not None else staged_names(spark, folder)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in found}


_METADATA = "run_metadata.json"


def read_run_metadata(spark: SparkSession, folder: str) -> dict[str, object]:
    """The generator's `run_metadata.json` beside the exports, if there is one."""
    path = f"{folder}/{_METADATA}"
    if not path_exists(spark, path):
        return {}
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_run_metadata(
    spark: SparkSession, folder: str, metadata: Mapping[str, object], force: bool = False
) -> None:
    text = spark.range(1).select(F.lit(json.dumps(dict(metadata))).alias("value"))
    mode = "overwrite" if force else "errorifexists"
    text.coalesce(1).write.mode(mode).text(f"{folder}/{_METADATA}")


def ingest(
    spark: SparkSession,
    raw_folder: str,
    stage_folder: str,
    words: Vocabulary,
    dataset_name: str,
    seed: int = 0,
    force: bool = False,
    run_id: str | None = None,
) -> str:
    """IO2: clean every export and stage it as Parquet. Returns the run id.

    The run id is the one given, else the generator's, else name, seed and current time. It is
    kept beside the staged tables, where later steps find it.
    """
    metadata = read_run_metadata(spark, raw_folder)
    run = str(run_id or metadata.get("run_id") or f"{dataset_name}-{seed}-{int(time.time())}")
    for name, df in clean_all(read_exports(spark, raw_folder), words).items():
        write_staged(df, f"{stage_folder}/{name}", force)
    stamp = {"dataset_name": dataset_name, "seed": seed, **metadata, "run_id": run}
    write_run_metadata(spark, stage_folder, stamp, force)
    return run


def write_csv(df: DataFrame, path: str) -> None:
    """IO9: CSV with a header, which is written even when there are no rows.

    Spark writes no header for a frame without partitions, so an empty frame is brought to one.
    """
    df.repartition(1).write.mode("overwrite").csv(path, header=True, escape='"')
