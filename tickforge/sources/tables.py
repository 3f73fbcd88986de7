"""Stored ticks, and tick views of other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.schemas import TICKS
from tickforge.session import pin


def read_ticks(spark: SparkSession, *paths: str) -> DataFrame:
    """Ticks of Parquet folders, by the fixed schema."""
    if not paths:
        raise ValueError("no path given")
    return spark.read.schema(TICKS).parquet(*paths)


def _ns(ts: str):
    return (F.unix_micros(F.col(ts).cast("timestamp")) * 1000).alias("trade_time_ns")


def events_as_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Events as trades of EVT: the value is the price, 1 to 10.9 (by props.k) the quantity, views and errors the sellers."""
    e = pin(spark).read.parquet(f"{folder}/events.parquet")
    qty = (F.lit(10) + F.get_json_object("props", "$.k").cast("int")) / F.lit(10.0)
    rows = e.select(F.lit("EVT").alias("symbol"), F.col("event_id").alias("trade_id"), F.col("value").alias("price"), qty.alias("qty"), _ns("ts"), F.col("event_type").isin("error", "view").alias("is_buyer_maker"))
    return rows.withColumn("quote_qty", F.col("price") * F.col("qty")).select(*TICKS.names)


def lineitem_as_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as trades of LIN, with many equal times; ids are numbered in the order of (date, keys)."""
    li = pin(spark).read.parquet(f"{folder}/lineitem.parquet")
    day = Window.partitionBy("l_shipdate").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    before = Window.orderBy("l_shipdate").rowsBetween(Window.unboundedPreceding, -1)
    # numbered inside each day, then shifted by the days before (a row a day)
    counts = li.groupBy("l_shipdate").count().select("l_shipdate", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    rows = li.withColumn("_n", F.row_number().over(day)).join(counts, "l_shipdate")
    return rows.select(
        F.lit("LIN").alias("symbol"), (F.col("_n") + F.col("_before")).alias("trade_id"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("quote_qty"), _ns("l_shipdate"), (F.col("l_returnflag") == "R").alias("is_buyer_maker"),
    ).select(*TICKS.names)
