"""Distributed file writers (each is one write action; no driver collect)."""

from __future__ import annotations

import os
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.operators.clean import split_tag
from tradewatch.sinks.versions import Versions


def land_raw(lines: DataFrame, path: str) -> str:
    """Bronze copy of raw text lines (overwrite): each line's characters unchanged, one line feed after each."""
    lines.select("value").write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def run_id_from(ts) -> F.Column:
    """Run id in the ``yyyyMMdd_HHmmss`` form from a timestamp column."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def _run_versions(spark: SparkSession, base: str, run_id: str) -> Versions:
    return Versions(spark, folder(base, f"run_id={quote(run_id, safe='')}"))


def write_run(df: DataFrame, base: str, run_id: str) -> str:
    """Write ``df`` as the run ``base/run_id=<id>``, replacing only that run.

    The files go to a version folder of their own and become the run when they are complete, so a write that fails
    leaves an earlier one of the same run as it was, on any storage.
    """
    versions = _run_versions(df.sparkSession, base, run_id)
    name = versions.begin()
    try:
        df.write.mode("errorifexists").parquet(versions.path(name))
    except Exception:
        versions.discard(name)
        raise
    versions.publish(name)
    return base


def read_run(spark: SparkSession, base: str, schema, run_id: str) -> DataFrame:
    """One run's rows, from its live version (none: no rows)."""
    fields = [f for f in schema.fields if f.name != "run_id"]
    live = _run_versions(spark, base, run_id).live_path()
    rows = spark.read.schema(T.StructType(fields)).parquet(live) if live else spark.createDataFrame([], T.StructType(fields))
    return rows.withColumn("run_id", F.lit(run_id))


def clean_run(spark: SparkSession, base: str, run_id: str, unfinished_hours: float = 24) -> list[str]:
    """Deletes a run's replaced and abandoned versions."""
    return _run_versions(spark, base, run_id).clean(unfinished_hours)


def write_tagged(tagged: DataFrame, path: str) -> str:
    """Tagged clean records, one folder per record type."""
    split_tag(tagged).select(F.col("payload").alias("value"), "record_type").write.mode("overwrite").partitionBy(
        "record_type"
    ).text(path)
    return path


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """Rebuild ``TYPE<TAB>payload`` lines from the per-type folders."""
    df = spark.read.schema("value string, record_type string").text(path)
    return df.select(F.concat_ws("\t", "record_type", "value").alias("value"))


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", ordered: bool = False) -> str:
    """Write CSV files near the session's advisory partition size.

    Rows are rebalanced first (small pieces together, large ones apart); ``ordered`` rows keep their order, and the
    shuffle that sorted them has coalesced them already.
    """
    sized = df if ordered else df.hint("rebalance")
    sized.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)
    return path


def insert_overwrite_directory(spark: SparkSession, view: str, path: str, sep: str = ",") -> str:
    """``INSERT OVERWRITE DIRECTORY`` of a registered view as delimited text."""
    spark.sql(
        f"INSERT OVERWRITE DIRECTORY '{path}' USING csv OPTIONS (sep '{sep}', header 'false') SELECT * FROM {view}"
    )
    return path


def folder(base: str, *parts: str) -> str:
    return os.path.join(base, *parts)
