"""Fixed schemas of raw trades, ticks, bars and the ledger."""

from pyspark.sql import types as T

SCHEMA_VERSION, FEATURE_VERSION, SOFTWARE_VERSION = "2.0", "2.0", "2.0.0"


def _struct(text: str) -> T.StructType:
    kinds = {"s": T.StringType(), "l": T.LongType(), "d": T.DoubleType(), "b": T.BooleanType(), "t": T.TimestampType(), "i": T.IntegerType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in text.split())])


#: Positional columns of an archive's CSV, with the row's place in its file.
RAW_TRADES = _struct("trade_id:l price:d qty:d quote_qty:d trade_time_raw:l is_buyer_maker:b")
TICKS = _struct("symbol:s trade_id:l price:d qty:d quote_qty:d trade_time_ns:l is_buyer_maker:b")
BARS = _struct("symbol:s bar_time:t open:d high:d low:d close:d volume:d quote_volume:d vwap:d taker_buy_volume:d taker_sell_volume:d trade_count:l avg_trade_size:d max_trade_size:d")
INTERVALS = ("1s", "1min", "5min", "15min", "30min", "1h", "4h", "1d", "1w", "1mo")
