"""Session VWAP."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.scalar import EXACT, ratio


def session_vwap(bars: DataFrame, exact: bool = False) -> DataFrame:
    """Running VWAP of each UTC day and the close's deviation from it."""
    w = Window.partitionBy("symbol", "session").orderBy("bar_time").rowsBetween(Window.unboundedPreceding, 0)

    def running(c: str):
        return F.sum(F.col(c).cast(EXACT)).over(w).cast("double") if exact else F.sum(c).over(w)

    rows = bars.withColumn("session", F.date_trunc("day", "bar_time"))
    rows = rows.select("symbol", "bar_time", "session", "close", running("quote_volume").alias("session_cumulative_quote_volume"), running("volume").alias("session_cumulative_volume"))
    rows = rows.withColumn("session_vwap", ratio(F.col("session_cumulative_quote_volume"), F.col("session_cumulative_volume")))
    return rows.withColumn("vwap_deviation", F.col("close") - F.col("session_vwap"))
