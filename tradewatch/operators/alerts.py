"""Read side of the stored results: ranking, counts by severity, display columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch import profiles as P
from tradewatch.functions import scoring


def alerts_ranked(results: DataFrame) -> DataFrame:
    """Alerts by score, highest first (range-partitioned global sort, keys as tie-break)."""
    keys = [c for c in ("id", "trade_id") if c in results.columns]
    return results.orderBy(F.desc("suspicion_score"), *keys)


def alert_stats(results: DataFrame) -> DataFrame:
    """One row: total, critical (>= 90) and moderate (70-89) alerts."""
    s = F.col("suspicion_score")
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s >= P.CRITICAL_AT).alias("critical"),
        F.count_if((s >= P.MODERATE_AT) & (s < P.CRITICAL_AT)).alias("moderate"),
    )


def alerts_display(results: DataFrame) -> DataFrame:
    """Display columns: thousands-separated quantity, score label, severity, detection time or a dash."""
    detected = (
        F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss") if "detected_at" in results.columns else F.lit(None).cast("string")
    )
    keys = [c for c in ("id", "trade_id") if c in results.columns]
    return results.select(
        *keys,
        "trader_id",
        "stock",
        F.format_number("quantity", 0).alias("quantity_display"),
        "reason",
        F.concat(F.col("suspicion_score").cast("string"), F.lit("%")).alias("score_label"),
        scoring.severity("suspicion_score").alias("severity"),
        F.coalesce(detected, F.lit("—")).alias("detected_display"),
    )
