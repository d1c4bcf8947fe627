"""Joining a derived, usually small side (per stock, per stock-day) to trades.

The small side is materialised as a Parquet table in the shared folder (one
job, lineage cut, row count observed on that write), and it is broadcast only
under that proven bound.  Above the bound the join falls back to a shuffle
join on the keys; AQE's skew-join handling then splits the partitions of hot keys on the
trade side, so one stock holding a third of all trades does not land in one
task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tradewatch.session import broadcast_max_bytes, broadcast_max_rows, materialize_measured

# In-memory width per value of fixed-width types; texts are measured.
_WIDTH = {T.DateType: 4, T.IntegerType: 4, T.BooleanType: 1}
_UNMEASURED_TEXT = 32  # per text value of a side whose texts were not measured


@dataclass(frozen=True)
class Side:
    """A derived side already written to the shared folder, with its proven row count
    and the bytes of its texts as measured on that write (None: not measured)."""

    df: DataFrame
    rows: int
    text_bytes: int | None = None

    def size(self) -> int:
        """Bytes of a broadcast relation (8 bytes of slot per field plus payload)."""
        fields = self.df.schema.fields
        texts = sum(isinstance(f.dataType, T.StringType) for f in fields)
        text_bytes = self.rows * texts * _UNMEASURED_TEXT if self.text_bytes is None else self.text_bytes
        return text_bytes + self.rows * sum(8 + (0 if isinstance(f.dataType, T.StringType) else _WIDTH.get(type(f.dataType), 8)) for f in fields)


def small_side(df: DataFrame, name: str = "small_side") -> Side:
    """Materialise ``df`` (one job) and keep its row count and text bytes."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    measured = sum(texts, F.lit(0)).cast("long")
    table, rows, text_bytes = materialize_measured(df, name, measured)
    return Side(table, rows, text_bytes)


def bounded_small(small: DataFrame | Side, max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Materialise ``small`` unless it already is; report whether it is within the
    broadcast bounds (row count and bytes)."""
    side = small if isinstance(small, Side) else small_side(small)
    spark = side.df.sparkSession
    rows_ok = side.rows <= (broadcast_max_rows(spark) if max_rows is None else max_rows)
    return side.df, rows_ok and side.size() <= broadcast_max_bytes(spark)


def join_small(big: DataFrame, small: DataFrame | Side, on, how: str = "left", max_rows: int | None = None) -> DataFrame:
    """``big JOIN small`` with a size-checked broadcast of ``small``."""
    small_df, fits = bounded_small(small, max_rows)
    if fits:
        return big.join(F.broadcast(small_df), on, how)
    return big.join(small_df, on, how)
