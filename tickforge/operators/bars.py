"""OHLCV bars.

Bars of a coarse interval can be made of ticks or, with the same result, of
finer bars: the state of a bar (first and last trade's key, sums, extremes) is
mergeable.  ``cascade`` makes all intervals from one pass over the ticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.scalar import EXACT, bar_start, ratio, restart, total, valid
from tickforge.schemas import BARS, INTERVALS

def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks with a price and a quantity above 0."""
    return ticks.where(valid("price", "qty"))


def _sum(column: str, exact: bool):
    return F.sum(F.col(column).cast(EXACT)) if exact else F.sum(column)


def bar_state(ticks: DataFrame, interval: str, exact: bool = False) -> DataFrame:
    """Mergeable bars: open and close carry the key (time, id) that decides ties."""
    key = F.struct("trade_time_ns", "trade_id")
    rows = ticks.select(
        "symbol", bar_start("trade_time_ns", interval).alias("bar_time"), key.alias("key"), "price", "qty", "quote_qty",
        F.when(F.col("is_buyer_maker"), 0.0).otherwise(F.col("qty")).alias("buy"), F.when(F.col("is_buyer_maker"), F.col("qty")).otherwise(0.0).alias("sell"),
    )
    return rows.groupBy("symbol", "bar_time").agg(
        F.min(F.struct("key", "price")).alias("first"), F.max(F.struct("key", "price")).alias("last"), F.max("price").alias("high"), F.min("price").alias("low"),
        _sum("qty", exact).alias("volume"), _sum("quote_qty", exact).alias("quote_volume"), _sum("buy", exact).alias("buy"), _sum("sell", exact).alias("sell"),
        F.count(F.lit(1)).alias("trade_count"), F.max("qty").alias("max_trade_size"),
    )


def merge_state(state: DataFrame, interval: str) -> DataFrame:
    """Coarser mergeable bars of finer ones."""
    rows = state.withColumn("bar_time", restart("bar_time", interval))
    sums = [F.sum(c).alias(c) for c in ("volume", "quote_volume", "buy", "sell", "trade_count")]
    return rows.groupBy("symbol", "bar_time").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"), *sums, F.max("max_trade_size").alias("max_trade_size"))


def finish(state: DataFrame) -> DataFrame:
    """The 14 columns of bars."""
    d = {c: F.col(c).cast("double") for c in ("volume", "quote_volume", "buy", "sell")}
    out = state.select(
        "symbol", "bar_time", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), d["volume"].alias("volume"), d["quote_volume"].alias("quote_volume"),
        ratio(d["quote_volume"], d["volume"]).alias("vwap"), d["buy"].alias("taker_buy_volume"), d["sell"].alias("taker_sell_volume"), F.col("trade_count").cast("long").alias("trade_count"),
        ratio(d["volume"], F.col("trade_count").cast("double")).alias("avg_trade_size"), "max_trade_size",
    )
    return out.select(*BARS.names)


def bars(ticks: DataFrame, interval: str, exact: bool = False) -> DataFrame:
    """Bars of one interval: a row for each bucket with trades.  open and close are by time, then trade_id."""
    return finish(bar_state(ticks, interval, exact))


def cascade(ticks: DataFrame, intervals: tuple[str, ...] = INTERVALS, exact: bool = False, keep=None) -> dict[str, DataFrame]:
    """Bars of all intervals: the finest is made of ticks, each other one of the coarsest before it whose bars lie inside its own; keep(name, state) may store a state and return what was stored."""
    states: dict[str, DataFrame] = {}
    for i in (i for i in INTERVALS if i in intervals):
        # bars of a week or a month nest in nothing
        finer = [j for j in states if j not in ("1w", "1mo")]
        state = merge_state(states[finer[-1]], i) if finer else bar_state(ticks, i, exact)
        states[i] = keep(i, state) if keep else state
    return {i: finish(states[i]) for i in intervals}


__all__ = ["bars", "bar_state", "cascade", "finish", "merge_state", "total", "valid_ticks"]
