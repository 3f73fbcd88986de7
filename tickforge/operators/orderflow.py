"""Order flow of bars and ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.scalar import EXACT, bucket_micros, ratio, total
from tickforge.operators.history import blocked, in_block, previous, running_sum


def _running(column: str, window, exact: bool):
    return F.sum(F.col(column).cast(EXACT)).over(window).cast("double") if exact else F.sum(column).over(window)


def orderflow(bars: DataFrame, exact: bool = False) -> DataFrame:
    """bars with delta, taker_buy_ratio, cumulative_delta and session_cumulative_delta.

    The running sum over the whole history is made in two phases: inside each
    UTC day, and over the days' totals; so no task gets more than one day of a
    symbol (and the days' totals, a row each).
    """
    day = F.date_trunc("day", "bar_time")
    delta = F.col("taker_buy_volume") - F.col("taker_sell_volume")
    rows = bars.withColumn("delta", delta).withColumn("taker_buy_ratio", ratio(F.col("taker_buy_volume"), F.col("taker_buy_volume") + F.col("taker_sell_volume"))).withColumn("_day", day)
    inside = Window.partitionBy("symbol", "_day").orderBy("bar_time").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("session_cumulative_delta", _running("delta", inside, exact))
    before = Window.partitionBy("symbol").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("symbol", "_day").agg(total(F.col("delta"), exact).alias("_sum"))
    sums = sums.select("symbol", "_day", F.coalesce(_running("_sum", before, exact), F.lit(0.0)).alias("_before"))
    out = rows.join(sums, ["symbol", "_day"])
    both = (F.col("_before").cast(EXACT) + F.col("session_cumulative_delta").cast(EXACT)).cast("double") if exact else F.col("_before") + F.col("session_cumulative_delta")
    return out.withColumn("cumulative_delta", both).select(*bars.columns, "delta", "taker_buy_ratio", "cumulative_delta", "session_cumulative_delta")


def exact_quantile(rows: DataFrame, column: str, q: float, name: str, accuracy: int = 100_000) -> DataFrame:
    """(symbol, name): each symbol's quantile, interpolated between neighbours.

    A sketch gives a narrow range that the quantile must lie in (the whole
    range for symbols with few rows); only the distinct values there are counted
    and ranked, everything below is one count.
    """
    x, margin = F.col(column), 3 / accuracy
    range_ = F.percentile_approx(x, [max(0.0, q - margin), min(1.0, q + margin)], accuracy)
    near = rows.groupBy("symbol").agg(range_.alias("_r"), F.min(x).alias("_min"), F.max(x).alias("_max"), F.count(x).alias("_count"))
    few = F.col("_count") <= accuracy
    near = near.select("symbol", F.when(few, F.col("_min")).otherwise(F.col("_r")[0]).alias("_lo"), F.when(few, F.col("_max")).otherwise(F.col("_r")[1]).alias("_hi"), (F.lit(q) * (F.col("_count") - 1)).alias("_at"))
    inside = rows.select("symbol", x.alias("_x")).join(near, "symbol").where(F.col("_x") <= F.col("_hi"))
    counts = inside.groupBy("symbol", "_at", F.when(F.col("_x") >= F.col("_lo"), F.col("_x")).alias("_x")).agg(F.count(F.lit(1)).alias("_own"))
    # below the range: no value, so first in the order, and never the quantile itself
    ranked = counts.withColumn("_upto", F.sum("_own").over(Window.partitionBy("symbol").orderBy(F.col("_x").asc_nulls_first())))
    at = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_x")))
    both = ranked.groupBy("symbol", "_at").agg(at(F.floor("_at")).alias("_low"), at(F.ceil("_at")).alias("_high"))
    share = F.col("_at") - F.floor("_at")
    return both.select("symbol", F.when(share == 0, F.col("_low")).otherwise((F.ceil("_at") - F.col("_at")) * F.col("_low") + share * F.col("_high")).alias(name))


def large_trades(ticks: DataFrame, quantile: float = 0.99, exact: bool = False) -> DataFrame:
    """Ticks whose qty reaches their symbol's quantile; exact: the interpolated one, else a sketch's."""
    threshold = exact_quantile(ticks, "qty", quantile, "_threshold") if exact else ticks.groupBy("symbol").agg(F.percentile_approx("qty", quantile, 10_000).alias("_threshold"))
    # one row for each symbol; left to Spark whether it is small enough to send around
    out = ticks.join(threshold, "symbol").where(F.col("qty") >= F.col("_threshold"))
    return out.select("symbol", "trade_id", "price", "qty", "quote_qty", "trade_time_ns", "is_buyer_maker")


def stacked_imbalances(bars: DataFrame, ratio_min: float = 3.0, min_bars: int = 3, strict_micros: int | None = None) -> DataFrame:
    """Bars in runs of one-sided imbalance.

    Bars without imbalance are passed over, so only the other side ends a run;
    with strict_micros (the bars' length) a missing or balanced bar ends it
    too.  A bar whose other side is 0 has no imbalance.
    """
    buy, sell = F.col("taker_buy_volume"), F.col("taker_sell_volume")
    side = F.when(buy >= F.lit(ratio_min) * F.nullif(sell, F.lit(0.0)), "buy").when(sell >= F.lit(ratio_min) * F.nullif(buy, F.lit(0.0)), "sell").otherwise("none")
    rows = bars.select("symbol", "bar_time", "close", "volume", "taker_buy_volume", "taker_sell_volume", side.alias("imbalance_side")).where("imbalance_side != 'none'")
    rows = previous(rows, F.struct("imbalance_side", F.unix_micros("bar_time").alias("at")), "_last")
    ended = F.col("_last.imbalance_side") != F.col("imbalance_side")
    if strict_micros:
        ended = ended | (F.unix_micros("bar_time") - F.col("_last.at") != F.lit(strict_micros))
    rows = running_sum(rows.withColumn("_ended", F.coalesce(ended, F.lit(True)).cast("long")).drop("_last"), F.col("_ended"), "_run")
    rows = rows.withColumn("island_length", F.count(F.lit(1)).over(Window.partitionBy("symbol", "_run")))
    return rows.where(F.col("island_length") >= min_bars).select("symbol", "bar_time", "close", "volume", "taker_buy_volume", "taker_sell_volume", "imbalance_side", "island_length")


def delta_divergence(flow: DataFrame, lookback: int = 20) -> DataFrame:
    """Bars whose close leaves the range of the bars before while cumulative delta does not follow."""
    w = in_block().rowsBetween(-lookback, -1)
    c, d = F.col("close"), F.col("cumulative_delta")
    rows = blocked(flow.select("symbol", "bar_time", "close", "cumulative_delta"), lookback)
    rows = rows.withColumns({"hi": F.max("close").over(w), "lo": F.min("close").over(w), "dhi": F.max("cumulative_delta").over(w), "dlo": F.min("cumulative_delta").over(w)}).where("_own")
    rows = rows.withColumn("bearish_divergence", (c > F.col("hi")) & (d <= F.col("dhi"))).withColumn("bullish_divergence", (c < F.col("lo")) & (d >= F.col("dlo")))
    return rows.where("hi is not null and (bearish_divergence or bullish_divergence)").select("symbol", "bar_time", "close", "cumulative_delta", "bearish_divergence", "bullish_divergence")


def iceberg_candidates(ticks: DataFrame, window_seconds: int = 2, min_repeats: int = 5, exact: bool = False) -> DataFrame:
    """Prices traded at least min_repeats times by one side in a bucket."""
    rows = ticks.select("symbol", "price", "is_buyer_maker", bucket_micros("trade_time_ns", window_seconds * 1_000_000).alias("bucket_time"), "qty")
    out = rows.groupBy("symbol", "price", "is_buyer_maker", "bucket_time").agg(F.count(F.lit(1)).alias("n_trades"), total(F.col("qty"), exact).alias("total_qty"), F.stddev_pop("qty").alias("qty_stddev"))
    return out.where(F.col("n_trades") >= min_repeats)
