"""Footprints, volume profiles and points of control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.scalar import EXACT, bar_start, bucket_micros, price_bin, restart, session_of, total


def footprint(ticks: DataFrame, interval: str = "1min", bin_size: float = 10.0, exact: bool = False) -> DataFrame:
    """Buy and sell volume of each bar and price bin."""
    rows = ticks.select("symbol", bar_start("trade_time_ns", interval).alias("bar_time"), price_bin("price", bin_size).alias("price_bin"), "qty", "is_buyer_maker")
    buy, sell = F.when(F.col("is_buyer_maker"), 0.0).otherwise(F.col("qty")), F.when(F.col("is_buyer_maker"), F.col("qty")).otherwise(0.0)
    out = rows.groupBy("symbol", "bar_time", "price_bin").agg(total(buy, exact).alias("buy_volume"), total(sell, exact).alias("sell_volume"), total(F.col("qty"), exact).alias("total_volume"), F.count(F.lit(1)).alias("trade_count"))
    return _with_delta(out)


def _with_delta(out: DataFrame) -> DataFrame:
    return out.select("symbol", "bar_time", "price_bin", "buy_volume", "sell_volume", (F.col("buy_volume") - F.col("sell_volume")).alias("delta"), "total_volume", "trade_count")


def footprint_rollup(fine: DataFrame, interval: str, exact: bool = False) -> DataFrame:
    """A coarser footprint of a finer one."""
    rows = fine.withColumn("bar_time", restart("bar_time", interval))
    out = rows.groupBy("symbol", "bar_time", "price_bin").agg(*[total(F.col(c), exact).alias(c) for c in ("buy_volume", "sell_volume", "total_volume")], F.sum("trade_count").alias("trade_count"))
    return _with_delta(out)


def session_histogram(ticks: DataFrame, bin_size: float = 10.0, exact: bool = False) -> DataFrame:
    """Volume by session (UTC day) and price bin."""
    rows = ticks.select("symbol", session_of("trade_time_ns").alias("session"), price_bin("price", bin_size).alias("price_bin"), "qty")
    return rows.groupBy("symbol", "session", "price_bin").agg(total(F.col("qty"), exact).alias("volume"))


def session_range(ticks: DataFrame, exact: bool = False) -> DataFrame:
    rows = ticks.select("symbol", session_of("trade_time_ns").alias("session"), "price", "qty")
    return rows.groupBy("symbol", "session").agg(F.min("price").alias("day_low"), F.max("price").alias("day_high"), total(F.col("qty"), exact).alias("day_volume"))


def _value_area(bins: Column, share: float) -> Column:
    """(poc, vah, val) of bins sorted by price.

    From the point of control (most volume, the lowest price of ties) the area
    takes the next traded bin above or below, whichever has more volume (above
    on ties), until it holds the share of all volume.  A fold over as many
    steps as there are bins; each step is constant work, so what it needs is
    carried in its state.
    """
    best = F.aggregate(bins, F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(-1.0).alias("v"), F.lit(0.0).alias("sum")), lambda s, b: F.struct((s["i"] + 1).alias("i"), F.when(b["volume"] > s["v"], s["i"]).otherwise(s["at"]).alias("at"), F.greatest(s["v"], b["volume"]).alias("v"), (s["sum"] + b["volume"]).alias("sum")))

    def step(s: Column, _: Column) -> Column:
        below = F.when(s["lo"] > 0, F.get(bins, s["lo"] - 1)["volume"]).otherwise(-1.0)
        above = F.when(s["hi"] < s["n"] - 1, F.get(bins, s["hi"] + 1)["volume"]).otherwise(-1.0)
        open_ = (s["acc"] < s["target"]) & ((s["lo"] > 0) | (s["hi"] < s["n"] - 1))
        up, down = open_ & (above >= below), open_ & (above < below)
        return F.struct(
            F.when(down, s["lo"] - 1).otherwise(s["lo"]).alias("lo"), F.when(up, s["hi"] + 1).otherwise(s["hi"]).alias("hi"),
            F.when(up, s["acc"] + above).when(down, s["acc"] + below).otherwise(s["acc"]).alias("acc"), s["target"].alias("target"), s["n"].alias("n"), s["at"].alias("at"),
        )

    start = F.aggregate(F.array(best), F.struct(*[F.lit(0).alias(c) for c in ("lo", "hi")], F.lit(0.0).alias("acc"), F.lit(0.0).alias("target"), F.lit(0).alias("n"), F.lit(0).alias("at")), lambda _, b: F.struct(b["at"].alias("lo"), b["at"].alias("hi"), b["v"].alias("acc"), (b["sum"] * F.lit(share)).alias("target"), b["i"].alias("n"), b["at"].alias("at")))
    edges = lambda s: F.struct(F.get(bins, s["at"])["price_bin"].alias("poc"), F.get(bins, s["hi"])["price_bin"].alias("vah"), F.get(bins, s["lo"])["price_bin"].alias("val"))
    return F.aggregate(F.sequence(F.lit(1), F.size(bins)), start, step, edges)


def value_area(histogram: DataFrame, share: float = 0.70) -> DataFrame:
    """poc, vah and val of each session."""
    rows = histogram.groupBy("symbol", "session").agg(F.array_sort(F.collect_list(F.struct("price_bin", "volume"))).alias("bins"))
    return rows.withColumn("area", _value_area(F.col("bins"), share)).select("symbol", "session", "area.poc", "area.vah", "area.val")


def session_volume_profile(histogram: DataFrame, share: float = 0.70, high: float = 0.90, low: float = 0.10) -> DataFrame:
    """The histogram with marks: point of control, value area, nodes of high and low volume."""
    quantiles = histogram.groupBy("symbol", "session").agg(F.percentile("volume", high).alias("_high"), F.percentile("volume", low).alias("_low"))
    rows = histogram.join(value_area(histogram, share).join(quantiles, ["symbol", "session"]), ["symbol", "session"])
    return rows.select("symbol", "session", "price_bin", "volume", (F.col("price_bin") == F.col("poc")).alias("is_poc"), F.col("price_bin").between(F.col("val"), F.col("vah")).alias("in_value_area"), (F.col("volume") >= F.col("_high")).alias("is_hvn"), (F.col("volume") <= F.col("_low")).alias("is_lvn"))


def profile_summary(histogram: DataFrame, ranges: DataFrame, share: float = 0.70) -> DataFrame:
    """Point of control, value area and range of each session; naked: no later session traded at the point of control.

    A later session's range meets a price iff it begins at or below and ends at
    or above it, which no single running extreme tells; the anti join is over
    sessions, a row a day.
    """
    rows = value_area(histogram, share).join(ranges, ["symbol", "session"], "left")
    later = rows.select(F.col("symbol").alias("s2"), F.col("session").alias("later"), F.col("day_low").alias("lo2"), F.col("day_high").alias("hi2"))
    met = rows.join(later, (F.col("symbol") == F.col("s2")) & (F.col("later") > F.col("session")) & F.col("poc").between(F.col("lo2"), F.col("hi2")), "left_semi").select("symbol", "session", F.lit(False).alias("_naked"))
    out = rows.join(met, ["symbol", "session"], "left")
    return out.select("symbol", "session", "poc", "vah", "val", "day_low", "day_high", "day_volume", F.coalesce("_naked", F.lit(True)).alias("is_poc_naked_as_of_latest_session"))


def developing_poc(ticks: DataFrame, bin_size: float = 10.0, minutes: int = 15, traded_only: bool = True, exact: bool = False) -> DataFrame:
    """Point of control of the session so far, at each step of so many minutes.

    traded_only: among the bins traded in the step; else among all bins of the
    session so far.  Ties go to the lowest price.
    """
    rows = ticks.select("symbol", session_of("trade_time_ns").alias("session"), bucket_micros("trade_time_ns", minutes * 60_000_000).alias("step_time"), price_bin("price", bin_size).alias("price_bin"), "qty")
    rows = rows.groupBy("symbol", "session", "step_time", "price_bin").agg(total(F.col("qty"), exact).alias("v"))
    by_bin = Window.partitionBy("symbol", "session", "price_bin").orderBy("step_time").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum(F.col("v").cast(EXACT)).over(by_bin).cast("double") if exact else F.sum("v").over(by_bin)
    rows = rows.withColumn("running_volume", run)
    best = F.max(F.struct(F.col("running_volume"), (-F.col("price_bin")).alias("neg")))
    if traded_only:
        out = rows.groupBy("symbol", "session", "step_time").agg(best.alias("b"))
    else:
        # running volumes only grow: the best so far is the best of all bins' values up to the step
        steps = rows.groupBy("symbol", "session", "step_time").agg(best.alias("b"))
        so_far = Window.partitionBy("symbol", "session").orderBy("step_time").rowsBetween(Window.unboundedPreceding, 0)
        out = steps.withColumn("b", F.max("b").over(so_far))
    return out.select("symbol", "session", "step_time", (-F.col("b.neg")).alias("developing_poc"), F.col("b.running_volume").alias("running_volume"))
