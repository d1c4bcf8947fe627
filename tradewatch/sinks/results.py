"""The results table: created if missing, fully replaced each run, clearable.

Rows are written by executors, never collected.  A table kept in the shared
folder is replaced by *publishing*: each run writes a fresh version folder
(``sinks/versions.py``) and then points the table at the newest published one
(``ALTER TABLE ... SET LOCATION``, metadata only), so readers see the old or the
new result set, never a half-written one, a failed job leaves the previous
results in place, and a run that started earlier but ends later does not
replace those of a newer run.  Alert ids are content
hashes of the trade keys, so a retried job rewrites the same ids (no global
counter).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.sinks.versions import Versions


def alert_id(*cols) -> F.Column:
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256)


def create_results_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the table if missing; with ``location`` it lives in that (shared) folder."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schemas.RESULTS_DDL}) USING parquet{where}")


def to_results(flagged: DataFrame, detected_at: str | None = None) -> DataFrame:
    """Flagged trades in the results layout.

    ``detected_at`` is the run's time as an argument (repeatable runs); the
    session clock is used only when none is given.
    """
    # UTC wall-clock time without zone, as the reference's CURRENT_TIMESTAMP default
    when = F.lit(detected_at) if detected_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    when = when.cast("timestamp_ntz")
    # rows that agree in the trade's keys (identical input lines) are told apart by a running number
    keys = ["trade_id", "trader_id", "stock"]
    again = F.row_number().over(Window.partitionBy(*keys).orderBy("quantity", "suspicion_score"))
    numbered = flagged.withColumn("again", F.when(again > 1, again))
    return numbered.select(
        alert_id(*keys, "again").alias("id"),
        "trader_id",
        "stock",
        F.col("quantity").cast("long").alias("quantity"),
        "reason",
        F.col("suspicion_score").cast("int").alias("suspicion_score"),
        when.alias("detected_at"),
    )


def _is_managed(spark: SparkSession, table: str) -> bool:
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Type'").select("data_type").first()
    return info is not None and info[0] == "MANAGED"


def point_at_newest(spark: SparkSession, table: str, versions: Versions) -> None:
    """Let the table show the newest published version.

    The switch is repeated until no newer version has appeared behind it, so of runs that switch at the same time the
    last one to look leaves the newest in place.
    """
    newest = None
    while newest != versions.newest():
        newest = versions.newest()
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{versions.path(newest)}'")
        else:
            create_results_table(spark, table, versions.path(newest))
    spark.catalog.refreshTable(table)


def publish(spark: SparkSession, rows: DataFrame, table: str, location: str, ticket: str | None = None) -> str:
    """Write ``rows`` to a new version folder under ``location``, then switch ``table`` to the newest version.

    ``ticket`` (``Versions.begin``) says when the run started; by default it starts now.
    """
    versions = Versions(spark, location)
    ticket = ticket or versions.begin()
    try:
        rows.write.mode("errorifexists").parquet(versions.path(ticket))
    except Exception:
        versions.discard(ticket)
        raise
    versions.publish(ticket)
    point_at_newest(spark, table, versions)
    return versions.path(ticket)


def clean_results(spark: SparkSession, location: str, unfinished_hours: float = 24, lease_hours: float = 24) -> list[str]:
    """Deletes replaced and abandoned versions under ``location`` but those that are being read (``reading_results``)."""
    return Versions(spark, location).clean(unfinished_hours, lease_hours)


@contextmanager
def reading_results(spark: SparkSession, location: str) -> Iterator[DataFrame]:
    """The live results as one version, kept from the cleaner while the block runs."""
    with Versions(spark, location).reading() as path:
        rows = spark.read.schema(schemas.RESULTS_DDL)
        yield rows.parquet(path) if path else spark.createDataFrame([], schemas.RESULTS_DDL)


def refresh_results(
    spark: SparkSession, flagged: DataFrame, table: str, detected_at: str | None = None, location: str | None = None, ticket: str | None = None
) -> str | None:
    """Replace all rows of ``table`` with ``flagged`` (an empty set empties it).

    With ``location`` (shared folder) the new set is published as a version,
    whose folder is returned; without, a managed table is overwritten in place.
    """
    rows = to_results(flagged, detected_at)
    if location and not (spark.catalog.tableExists(table) and _is_managed(spark, table)):
        return publish(spark, rows, table, location, ticket)
    create_results_table(spark, table)
    rows.write.insertInto(table, overwrite=True)
    return None


def clear_results(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Delete all rows: TRUNCATE for managed tables (Spark refuses it on
    external ones), otherwise publish an empty version."""
    if _is_managed(spark, table):
        spark.sql(f"TRUNCATE TABLE {table}")
        return
    empty = spark.createDataFrame([], spark.table(table).schema)
    if location:
        publish(spark, empty, table, location)
    else:
        empty.write.insertInto(table, overwrite=True)
