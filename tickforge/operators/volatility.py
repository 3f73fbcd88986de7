"""True range, Wilder ATR, realized volatility and absorption candidates."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.scalar import ratio
from tickforge.operators.history import BLOCK, blocked, in_block, previous

#: Weight below which what an average started from cannot show in a double.
NOTHING = 1e-19


def _true_range(before: Column) -> Column:
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def true_range(bars: DataFrame) -> DataFrame:
    """max(high - low, |high - previous close|, |low - previous close|); not for the first bar."""
    rows = previous(bars.select("symbol", "bar_time", "high", "low", "close"), F.col("close"), "before").where("before is not null")
    return rows.select("symbol", "bar_time", _true_range(F.col("before")).alias("true_range"))


def atr(bars: DataFrame, period: int = 14, block: int = BLOCK) -> DataFrame:
    """true_range and its average atr: atr = (1 - 1/period) * atr before + true_range / period, seeded with the first true range.

    Blocks of bars are averaged on their own.  The weight of what came before
    shrinks by 1 - 1/period a bar, so each block starts as many bars early as
    bring it below a double's precision; the first block starts from the seed.
    """
    reach = 2 if period == 1 else math.ceil(math.log(NOTHING) / math.log(1 - 1 / period)) + 1
    rows = blocked(bars.select("symbol", "bar_time", "high", "low", "close"), reach, block)
    rows = rows.withColumn("true_range", _true_range(F.lag("close").over(in_block()))).where("true_range is not null and _n > 0")
    # greatest() passes over nulls: the first bar of a block's lead has no close before it
    rows = rows.select("symbol", "_block", "bar_time", "_n", "_own", "true_range")

    def averaged(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("_n")
        p["atr"] = p["true_range"].ewm(alpha=1 / period, adjust=False).mean()
        return p.loc[p["_own"], ["symbol", "bar_time", "true_range", "atr"]]

    return rows.groupBy("symbol", "_block").applyInPandas(averaged, "symbol string, bar_time timestamp, true_range double, atr double")


def realized_volatility(bars: DataFrame, window: int = 30) -> DataFrame:
    """Sample deviation of the last ``window`` log returns; not annualised.

    Bars of valid ticks have closes above 0; others are passed over.
    """
    rows = blocked(bars.select("symbol", "bar_time", "close").where("close > 0 and not isnan(close)"), window)
    rows = rows.withColumn("log_return", F.ln(ratio(F.col("close"), F.lag("close").over(in_block())))).where("log_return is not null")
    rows = rows.withColumn("realized_vol", F.stddev_samp("log_return").over(in_block().rowsBetween(-(window - 1), 0)))
    return rows.where("_own").select("symbol", "bar_time", "close", "log_return", "realized_vol")


def absorption_candidates(bars: DataFrame, volume_quantile: float = 0.9, rows: int = 43_200, block: int = BLOCK) -> DataFrame:
    """Bars with much volume and little range for the ``rows`` bars up to and with them.

    Exact rolling quantiles, in blocks: each block gets the bars that its
    windows reach back to, so blocks are independent of each other.
    """
    series = blocked(bars.select("symbol", "bar_time", "close", "volume", (F.col("high") - F.col("low")).alias("bar_range")), rows, block)

    def f(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("_n")
        high = p["volume"].rolling(rows + 1, min_periods=1).quantile(volume_quantile)
        half = p["bar_range"].rolling(rows + 1, min_periods=1).quantile(0.5)
        out = p.loc[(p["volume"] >= high) & (p["bar_range"] <= half) & p["_own"], ["symbol", "bar_time", "close", "volume", "bar_range"]].copy()
        out["absorption_candidate"] = True
        return out

    return series.groupBy("symbol", "_block").applyInPandas(f, "symbol string, bar_time timestamp, close double, volume double, bar_range double, absorption_candidate boolean")
