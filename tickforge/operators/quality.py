"""Checks of ticks in the order of their source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the source that one window task compares.
CHUNK = 1_000_000
_FIELDS = ("price", "qty", "trade_id", "trade_time_ns", "is_buyer_maker")


def with_previous(ticks: DataFrame, order: str = "source_row", by: tuple[str, ...] = ("symbol",), chunk: int = CHUNK) -> DataFrame:
    """ticks with prev, the row before in source order.

    Rows are compared in chunks of the source; the first row of a chunk gets the
    last one of the chunk before from a table of one row a chunk.
    """
    row = F.struct(*_FIELDS)
    rows = ticks.withColumn("_chunk", F.floor(F.col(order) / chunk))
    inside = Window.partitionBy(*by, "_chunk").orderBy(order)
    lasts = rows.groupBy(*by, "_chunk").agg(F.max_by(row, F.col(order)).alias("_last"))
    lasts = lasts.select(*by, "_chunk", F.lag("_last").over(Window.partitionBy(*by).orderBy("_chunk")).alias("_carry"))
    out = rows.withColumn("prev", F.lag(row).over(inside)).join(lasts, [*by, "_chunk"])
    return out.withColumn("prev", F.coalesce("prev", "_carry")).drop("_carry", "_chunk")


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def validation_report(ticks: DataFrame, order: str = "source_row", by: tuple[str, ...] | None = None, jump: float = 0.05, chunk: int = CHUNK) -> DataFrame:
    """One row of counters for each group; all rows count, also those that ingestion rejects.

    A group is a symbol, and where ticks name their source_file, a file of it:
    source rows are counted from 0 in each file.

    Ids and duplicates are compared with the row before; a repeated id is a
    duplicate row if price, quantity and side are equal too (NaN equals
    nothing), else a conflict.  A jump is a relative price change beyond
    ``jump`` from a price above 0.
    """
    by = by or (("symbol", "source_file") if "source_file" in ticks.columns else ("symbol",))
    p, q = F.col("price"), F.col("qty")
    prev = lambda c: F.col(f"prev.{c}")
    gap = F.col("trade_id") - prev("trade_id")
    bad = (p <= 0) | (q <= 0) | F.isnan(p) | F.isnan(q)
    same = (p == prev("price")) & (q == prev("qty")) & (F.col("is_buyer_maker") == prev("is_buyer_maker")) & ~F.isnan(p) & ~F.isnan(q)
    repeat = gap == 0
    change = F.abs(F.try_divide(p - prev("price"), prev("price")))
    rows = with_previous(ticks, order, by, chunk)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_seen"),
        _count(bad).alias("n_price_qty_anomalies"),
        _count(F.col("trade_time_ns") < prev("trade_time_ns")).alias("n_non_monotonic_time"),
        _count(gap > 1).alias("n_id_gaps"),
        F.coalesce(F.sum(F.when(gap > 1, gap - 1)), F.lit(0)).alias("n_missing_ids"),
        _count(repeat).alias("n_duplicate_trade_ids"),
        _count(repeat & same).alias("n_duplicate_rows"),
        _count(repeat & ~F.coalesce(same, F.lit(False))).alias("n_conflicting_duplicate_trade_ids"),
        _count((prev("price") > 0) & ~F.isnan(prev("price")) & (change > jump) & ~F.isnan(change)).alias("n_abnormal_price_jumps"),
        F.min("trade_id").alias("min_trade_id"), F.max("trade_id").alias("max_trade_id"),
        F.min("trade_time_ns").alias("min_trade_time_ns"), F.max("trade_time_ns").alias("max_trade_time_ns"),
    )


def duplicate_ids(ticks: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Ids that occur more than once anywhere, with their count."""
    return ticks.groupBy(*by, "trade_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def months(start: str, end: str, spark) -> DataFrame:
    """All months from start to end (YYYY-MM)."""
    return spark.range(1).select(F.date_format(F.explode(F.sequence(F.to_date(F.lit(f"{start}-01")), F.to_date(F.lit(f"{end}-01")), F.expr("interval 1 month"))), "yyyy-MM").alias("year_month"))


def missing_months(done: DataFrame, start: str) -> DataFrame:
    """Months from start to the latest one done that are not done."""
    span = done.agg(F.max("year_month").alias("latest")).where(F.col("latest") >= start)
    every = span.select(F.explode(F.sequence(F.to_date(F.lit(f"{start}-01")), F.to_date(F.concat("latest", F.lit("-01"))), F.expr("interval 1 month"))).alias("m"))
    return every.select(F.date_format("m", "yyyy-MM").alias("year_month")).join(done.select("year_month"), "year_month", "left_anti")


def next_month(done: DataFrame, start: str) -> DataFrame:
    """The month after the latest one done; start where none is."""
    latest = done.agg(F.max("year_month").alias("latest"))
    return latest.select(F.coalesce(F.date_format(F.add_months(F.to_date(F.concat("latest", F.lit("-01"))), 1), "yyyy-MM"), F.lit(start)).alias("next_month"))
