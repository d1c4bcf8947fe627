"""Fixed-width ordering keys for arg-max aggregates.

``max_by(x, struct(a, b))`` needs a struct-typed aggregation buffer, which
hash aggregation cannot hold, so Spark plans a sort-based aggregate - a sort
of every input partition.  A single DECIMAL(38,0) key that orders exactly like
``(a, b)`` keeps ``max_by`` in ``HashAggregate`` with map-side partial
aggregation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewatch.functions.parsing import col

_KEY = "decimal(38,0)"
_ID_SPAN = Decimal(10**20)  # > 2^64: room for any shifted long id
_ID_SHIFT = Decimal(2**63)  # moves negative longs above zero, order kept
_MICRO = Decimal(10**6)


def micros_of_day(ts) -> Column:
    """Microseconds since midnight of a timestamp's wall clock (zone-free for timestamp_ntz)."""
    ts = col(ts)
    whole = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast(_KEY) * F.lit(_MICRO)
    return (whole + F.date_part(F.lit("SECOND"), ts) * F.lit(_MICRO)).cast(_KEY)


def time_then_id_key(ts, trade_id) -> Column:
    """Exact ordering of trades within one day by (time of day, id) as one DECIMAL(38,0)."""
    shifted_id = col(trade_id).cast(_KEY) + F.lit(_ID_SHIFT).cast(_KEY)
    return (micros_of_day(ts) * F.lit(_ID_SPAN).cast(_KEY) + shifted_id).cast(_KEY)
