"""File arrival: each upload dropped in a landing folder triggers a full run of the pipeline.

Structured Streaming over the *names* of new files (``binaryFile`` source, only
``*.csv``, contents not read) -> ``foreachBatch``.  An upload is a sub-folder of
the landing folder with all its files, or a single file directly in it; writers
should move a finished upload in at once.  Every upload is a run of its own: it
reads its own files and no others, each by its own header (a file without a
required column stops the query), takes all six steps, is scored against its own
statistics (not history), and writes under its own run id.  Uploads that arrive
in one trigger run in order of their newest file (ties by name), and each
replaces the results of the one before, as in the reference.

The checkpoint lives in the shared folder, so a restarted query resumes with the
next unseen files.  A batch that was interrupted is offered again: the ledger in
the checkpoint folder names the uploads that were finished, and only the others
run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch import schemas
from tradewatch.plans import pipeline
from tradewatch.profiles import POST_TRADE, Profile
from tradewatch.session import scratch_path
from tradewatch.sources.files import CSV_GLOB, SOURCE_FILE, orders_to_trades, read_by_header, type_orders
from tradewatch.storage import Storage, literally

FILES_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
LEDGER = "uploads"
# What an upload in full trades must have; ids are made from the lines where there are none.
TRADE_COLUMNS = tuple(schemas.TRADES.fieldNames())


@dataclass(frozen=True)
class Upload:
    name: str  # first part of the path below the landing folder
    files: tuple[str, ...]


def arrival_stream(spark: SparkSession, landing: str) -> DataFrame:
    """path and modificationTime of new files."""
    source = spark.readStream.schema(FILES_SCHEMA).format("binaryFile")
    return source.option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", True).load(literally(landing)).select("path", "modificationTime")


def uploads_of(files: list[tuple], root: str) -> list[Upload]:
    """The uploads that files (path, time) belong to, in order of their newest file (ties by name).

    ``root`` is the landing folder's full name; names are compared decoded, part by part from there, so neither spaces
    nor signs nor folders that are named like the landing folder matter.
    """
    root = root.rstrip("/") + "/"
    by: dict[str, list[tuple]] = {}
    for path, modified in files:
        if not path.startswith(root):
            raise ValueError(f"{path} is not below {root}")
        by.setdefault(path[len(root) :].split("/", 1)[0], []).append((modified, path))
    return [Upload(name, tuple(sorted(p for _, p in found))) for name, found in sorted(by.items(), key=lambda x: (max(x[1])[0], x[0]))]


def read_upload(spark: SparkSession, upload: Upload, layout: str, profile: Profile, run_date: str | None) -> DataFrame:
    """The trades of one upload, from its own files."""
    if layout == "orders":
        day = F.to_date(F.lit(run_date)) if run_date else F.current_date()
        return orders_to_trades(type_orders(read_by_header(spark, list(upload.files)), profile.truncate_quantity), day)
    types = T.StructType(list(schemas.TRADES.fields))
    return read_by_header(spark, list(upload.files), TRADE_COLUMNS, types).drop(SOURCE_FILE).select(*TRADE_COLUMNS)


def run_on_arrival(
    spark: SparkSession,
    landing: str,
    closes: DataFrame,
    table: str,
    checkpoint: str,
    profile: Profile = POST_TRADE,
    detected_at: str | None = None,
    out: str | None = None,
    available_now: bool = True,
    layout: str = "trades",
    run_date: str | None = None,
):
    """Start the arrival query; with ``available_now`` it drains and stops.

    ``layout='orders'`` takes uploads as the reference writes them (five
    text columns, time of day only); the times are placed on ``run_date``
    (default: the batch's current date).  All outputs go under ``out``
    (default: a fresh folder under the shared one).
    """
    out = out or scratch_path(spark, "arrival-out")
    storage = Storage(spark)
    root = storage.qualified(landing)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # names and times of this trigger's files, which the file source lists on the driver as well
        found = [(r["path"], r["modificationTime"]) for r in batch.collect()]
        finished = {e.name for e in storage.entries(f"{checkpoint}/{LEDGER}")}
        for n, upload in enumerate(uploads_of(found, root)):
            run_id = f"arrival-{epoch_id}-{n}"
            if run_id in finished:
                continue
            trades = read_upload(spark, upload, layout, profile, run_date)
            pipeline.run(spark, trades, closes, out, profile, run_id, table, detected_at)
            storage.touch(f"{checkpoint}/{LEDGER}/{run_id}")

    writer = arrival_stream(spark, landing).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
