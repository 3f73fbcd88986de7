"""Bars of a stream: the batch operator's aggregation under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.scalar import FIXED_MICROS, instant
from tickforge.operators.bars import finish, valid_ticks


def streaming_bars(ticks: DataFrame, interval: str = "1min", late: str = "5 minutes") -> DataFrame:
    """Bars of a streaming tick table; a bar is final once the watermark has passed its end.  For fixed intervals."""
    if interval not in FIXED_MICROS:
        raise ValueError(f"{interval} follows the calendar; streams have fixed intervals")
    buy, sell = F.when(F.col("is_buyer_maker"), 0.0).otherwise(F.col("qty")), F.when(F.col("is_buyer_maker"), F.col("qty")).otherwise(0.0)
    rows = valid_ticks(ticks).withColumn("ts", instant("trade_time_ns")).withWatermark("ts", late).withColumn("key", F.struct("trade_time_ns", "trade_id"))
    state = rows.groupBy("symbol", F.window("ts", f"{FIXED_MICROS[interval] // 1_000_000} seconds").alias("w")).agg(
        F.min(F.struct("key", "price")).alias("first"), F.max(F.struct("key", "price")).alias("last"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.sum("qty").alias("volume"), F.sum("quote_qty").alias("quote_volume"), F.sum(buy).alias("buy"), F.sum(sell).alias("sell"), F.count(F.lit(1)).alias("trade_count"), F.max("qty").alias("max_trade_size"),
    )
    return finish(state.withColumn("bar_time", F.col("w.start")).drop("w"))
