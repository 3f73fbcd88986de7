"""Windows over a symbol's whole history, in parts.

A window partitioned by symbol alone is one task for the usual single symbol.
Here a history is cut into months or into blocks of rows, which are tasks of
their own; what a part needs from those before it comes from a small table of
one row a month, or as rows that two blocks share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bars of one block.
BLOCK = 50_000


def _by_month(rows: DataFrame, carried: Column, over: Column) -> tuple[DataFrame, DataFrame, Window]:
    """(rows with their month, a row a month with what the months before hand on, the window of a month)."""
    rows = rows.withColumn("_month", F.date_trunc("month", "bar_time"))
    months = rows.groupBy("symbol", "_month").agg(carried.alias("_own")).select("symbol", "_month", over.alias("_before"))
    return rows, months, Window.partitionBy("symbol", "_month").orderBy("bar_time")


def running_sum(rows: DataFrame, column: Column, name: str) -> DataFrame:
    """rows with the sum of an integer column up to and with each."""
    before = Window.partitionBy("symbol").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    rows, months, month = _by_month(rows.withColumn(name, column), F.sum(name), F.coalesce(F.sum("_own").over(before), F.lit(0)))
    inside = F.sum(name).over(month.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(name, inside).join(months, ["symbol", "_month"]).withColumn(name, F.col(name) + F.col("_before")).drop("_month", "_before")


def previous(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """rows with the value (not null) of the one before, null for the first."""
    handed = F.lag("_own").over(Window.partitionBy("symbol").orderBy("_month"))
    rows, months, month = _by_month(rows, F.max_by(value, F.col("bar_time")), handed)
    return rows.withColumn(name, F.lag(value).over(month)).join(months, ["symbol", "_month"]).withColumn(name, F.coalesce(name, "_before")).drop("_month", "_before")


def blocked(rows: DataFrame, reach: int, size: int = BLOCK) -> DataFrame:
    """rows with _n (their place from 0), _block, and _own: whether the row is the block's, or one of the ``reach`` rows before it that come along."""
    size = max(size, reach)
    rows = running_sum(rows, F.lit(1), "_n").withColumn("_n", F.col("_n") - 1)
    own = F.floor(F.col("_n") / size)
    dealt = rows.withColumn("_block", F.explode(F.array(own, own + 1)))
    return dealt.where(F.col("_n") >= F.col("_block") * size - reach).withColumn("_own", F.col("_n") >= F.col("_block") * size)


def in_block() -> Window:
    """The window of a block's rows, in order."""
    return Window.partitionBy("symbol", "_block").orderBy("bar_time")
