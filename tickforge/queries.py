"""The graded queries of the library and the SQL that each must equal.

Sums are of decimals of eight places in both, so the order of addition cannot
show; logarithms, deviations and recursions are rounded to six places.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.config import Config
from tickforge.functions.scalar import FIXED_MICROS, raw_to_ns
from tickforge.operators import bars as B
from tickforge.operators import orderflow as O
from tickforge.operators import profile as P
from tickforge.operators import quality as Q
from tickforge.operators import volatility as V
from tickforge.operators.vwap import session_vwap
from tickforge.plans import ingest, warehouse
from tickforge.plans.ledger import Ledger
from tickforge.schemas import BARS, INTERVALS
from tickforge.sources.archives import read_archives
from tickforge.sources.tables import events_as_ticks, lineitem_as_ticks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# --- SQL -------------------------------------------------------------------

_SQL_TICKS = {
    "events": """SELECT 'EVT' AS symbol, event_id AS trade_id, value AS price, ((10 + CAST(json_extract_string(props, '$.k') AS INT)) / 10.0)::DOUBLE AS qty,
  value * ((10 + CAST(json_extract_string(props, '$.k') AS INT)) / 10.0)::DOUBLE AS quote_qty, ts, event_type IN ('error', 'view') AS is_buyer_maker FROM events""",
    "lineitem": """SELECT 'LIN' AS symbol, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trade_id, l_extendedprice / l_quantity AS price,
  l_quantity AS qty, l_extendedprice AS quote_qty, l_shipdate AS ts, l_returnflag = 'R' AS is_buyer_maker FROM lineitem""",
}


def _d(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,8))) AS DOUBLE)"


def _over(x: str, w: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,8))) OVER ({w}) AS DOUBLE)"


def _start(interval: str, ts: str = "ts") -> str:
    if interval in FIXED_MICROS:
        return f"time_bucket(INTERVAL '{FIXED_MICROS[interval] // 1_000_000} seconds', {ts})"
    unit = {"1d": "day", "1w": "week", "1mo": "month"}[interval]
    return f"CAST(date_trunc('{unit}', {ts}) AS TIMESTAMP)"


def _with_ticks(table: str) -> str:
    return f"raw AS ({_SQL_TICKS[table]}), ticks AS (SELECT * FROM raw WHERE price > 0 AND qty > 0)"


def _bars_select(interval: str, source: str = "ticks") -> str:
    return f"""SELECT symbol, {_start(interval)} AS bar_time, arg_min(price, row(ts, trade_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, row(ts, trade_id)) AS close,
  {_d("qty")} AS volume, {_d("quote_qty")} AS quote_volume, {_d("quote_qty")} / NULLIF({_d("qty")}, 0) AS vwap,
  {_d("CASE WHEN is_buyer_maker THEN 0 ELSE qty END")} AS taker_buy_volume, {_d("CASE WHEN is_buyer_maker THEN qty ELSE 0 END")} AS taker_sell_volume,
  count(*)::BIGINT AS trade_count, {_d("qty")} / count(*) AS avg_trade_size, max(qty) AS max_trade_size
  FROM {source} GROUP BY symbol, {_start(interval)}"""


def _with_bars(interval: str = "1h", table: str = "events") -> str:
    return f"WITH RECURSIVE {_with_ticks(table)}, bars AS ({_bars_select(interval)})"


_FLOW = f"""flow AS (SELECT *, taker_buy_volume - taker_sell_volume AS delta, taker_buy_volume / NULLIF(taker_buy_volume + taker_sell_volume, 0) AS taker_buy_ratio,
  {_over("taker_buy_volume - taker_sell_volume", "PARTITION BY symbol ORDER BY bar_time")} AS cumulative_delta,
  {_over("taker_buy_volume - taker_sell_volume", "PARTITION BY symbol, date_trunc('day', bar_time) ORDER BY bar_time")} AS session_cumulative_delta FROM bars)"""

_HIST = f"""hist AS (SELECT symbol, CAST(date_trunc('day', ts) AS TIMESTAMP) AS session, floor(price / 10.0::DOUBLE) * 10.0::DOUBLE AS price_bin, {_d("qty")} AS volume FROM ticks GROUP BY ALL)"""
_RANGE = f"""ranges AS (SELECT symbol, CAST(date_trunc('day', ts) AS TIMESTAMP) AS session, min(price) AS day_low, max(price) AS day_high, {_d("qty")} AS day_volume FROM ticks GROUP BY ALL)"""
_AREA = """bins AS (SELECT symbol, session, list(price_bin ORDER BY price_bin) AS ps, list(volume ORDER BY price_bin) AS vs FROM hist GROUP BY ALL),
start AS (SELECT symbol, session, ps, vs, len(vs) AS n, list_position(vs, list_max(vs)) AS peak, list_sum(vs) * 0.7::DOUBLE AS target FROM bins),
fold AS (SELECT symbol, session, peak AS lo, peak AS hi, vs[peak] AS acc, 0 AS step FROM start
  UNION ALL SELECT f.symbol, f.session, CASE WHEN above >= below THEN lo ELSE lo - 1 END, CASE WHEN above >= below THEN hi + 1 ELSE hi END, acc + greatest(above, below), step + 1
  FROM (SELECT f.*, s.target, s.n, CASE WHEN lo > 1 THEN vs[lo - 1] ELSE -1 END AS below, CASE WHEN hi < n THEN vs[hi + 1] ELSE -1 END AS above FROM fold f JOIN start s ON f.symbol = s.symbol AND f.session = s.session) f
  WHERE acc < target AND (lo > 1 OR hi < n)),
area AS (SELECT s.symbol, s.session, ps[peak] AS poc, ps[arg_max(hi, step)] AS vah, ps[arg_max(lo, step)] AS val FROM fold f JOIN start s ON f.symbol = s.symbol AND f.session = s.session GROUP BY s.symbol, s.session, ps, peak)"""


# --- registration ----------------------------------------------------------


def _shown(out: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL has them."""
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in out.dtypes])


def _register(name: str, sql: str | None, f: Query) -> None:
    QUERIES[name] = lambda spark, folder: _shown(f(spark, folder))
    if sql:
        ORACLES[name] = sql


def _ticks(table: str, spark: SparkSession, folder: str) -> DataFrame:
    return B.valid_ticks((events_as_ticks if table == "events" else lineitem_as_ticks)(spark, folder))


def _bars(spark: SparkSession, folder: str, interval: str = "1h") -> DataFrame:
    return B.bars(_ticks("events", spark, folder), interval, exact=True)


for _i in INTERVALS:
    _register(f"bars_{_i}", f"WITH {_with_ticks('events')} {_bars_select(_i)}", lambda s, d, i=_i: _bars(s, d, i))
for _i in ("1d", "1w", "1mo"):
    _register(f"bars_lineitem_{_i}", f"WITH {_with_ticks('lineitem')} {_bars_select(_i)}", lambda s, d, i=_i: B.bars(_ticks("lineitem", s, d), i, exact=True))
for _i in ("1min", "1h", "1d", "1mo"):
    _register(f"bars_cascade_{_i}", f"WITH {_with_ticks('events')} {_bars_select(_i)}", lambda s, d, i=_i: B.cascade(_ticks("events", s, d), ("1s", i), exact=True)[i])
for _i in ("1min", "5min", "15min", "1h"):
    _register(f"orderflow_{_i}", f"{_with_bars(_i)}, {_FLOW} SELECT * FROM flow", lambda s, d, i=_i: O.orderflow(_bars(s, d, i), exact=True))

_register(
    "session_vwap_1min",
    f"""{_with_bars("1min")}, s AS (SELECT symbol, bar_time, CAST(date_trunc('day', bar_time) AS TIMESTAMP) AS session, close,
  {_over("quote_volume", "PARTITION BY symbol, date_trunc('day', bar_time) ORDER BY bar_time")} AS session_cumulative_quote_volume,
  {_over("volume", "PARTITION BY symbol, date_trunc('day', bar_time) ORDER BY bar_time")} AS session_cumulative_volume FROM bars)
SELECT *, session_cumulative_quote_volume / NULLIF(session_cumulative_volume, 0) AS session_vwap, close - session_cumulative_quote_volume / NULLIF(session_cumulative_volume, 0) AS vwap_deviation FROM s""",
    lambda s, d: session_vwap(_bars(s, d, "1min"), exact=True),
)

_TR = """tr AS (SELECT symbol, bar_time, greatest(high - low, abs(high - prev), abs(low - prev)) AS true_range FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY bar_time) AS prev FROM bars) WHERE prev IS NOT NULL)"""
_register("true_range_1h", f"{_with_bars()}, {_TR} SELECT * FROM tr", lambda s, d: V.true_range(_bars(s, d)))
_register(
    "atr_1h",
    f"""{_with_bars()}, {_TR}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_time) AS n FROM tr),
a AS (SELECT symbol, bar_time, true_range, true_range AS atr, n FROM n WHERE n = 1
  UNION ALL SELECT n.symbol, n.bar_time, n.true_range, (1 - 1 / 14.0::DOUBLE) * a.atr + n.true_range * (1 / 14.0::DOUBLE), n.n FROM a JOIN n ON n.symbol = a.symbol AND n.n = a.n + 1)
SELECT symbol, bar_time, round(true_range, 6) AS true_range, round(atr, 6) AS atr FROM a""",
    lambda s, d: V.atr(_bars(s, d)).withColumns({c: F.round(c, 6) for c in ("true_range", "atr")}),
)
_register(
    "realized_vol_1h",
    f"""{_with_bars()}, r AS (SELECT symbol, bar_time, close, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY bar_time)) AS log_return FROM bars)
SELECT symbol, bar_time, close, round(log_return, 6) AS log_return, round(stddev_samp(log_return) OVER (PARTITION BY symbol ORDER BY bar_time ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS realized_vol FROM r WHERE log_return IS NOT NULL""",
    lambda s, d: V.realized_volatility(_bars(s, d)).withColumns({c: F.round(c, 6) for c in ("log_return", "realized_vol")}),
)
_register(
    "large_trades",
    f"""WITH {_with_ticks("events")} SELECT symbol, trade_id, price, qty, quote_qty, epoch_us(ts) * 1000 AS trade_time_ns, is_buyer_maker FROM ticks WHERE qty >= (SELECT quantile_cont(qty, 0.99) FROM ticks)""",
    lambda s, d: O.large_trades(_ticks("events", s, d), exact=True),
)

_SIDE = """side AS (SELECT * FROM (SELECT *, CASE WHEN taker_buy_volume >= 3.0::DOUBLE * NULLIF(taker_sell_volume, 0) THEN 'buy' WHEN taker_sell_volume >= 3.0::DOUBLE * NULLIF(taker_buy_volume, 0) THEN 'sell' ELSE 'none' END AS imbalance_side FROM bars) WHERE imbalance_side <> 'none')"""
_STACK = "SELECT symbol, bar_time, close, volume, taker_buy_volume, taker_sell_volume, imbalance_side, island_length FROM (SELECT *, count(*) OVER (PARTITION BY symbol, imbalance_side, island) AS island_length FROM islands) WHERE island_length >= {k}"
_register(
    "stacked_imbalances",
    f"""{_with_bars()}, {_SIDE}, islands AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_time) - row_number() OVER (PARTITION BY symbol, imbalance_side ORDER BY bar_time) AS island FROM side) {_STACK.format(k=3)}""",
    lambda s, d: O.stacked_imbalances(_bars(s, d)),
)
_register(
    "stacked_imbalances_strict",
    f"""{_with_bars()}, {_SIDE}, islands AS (SELECT *, bar_time - to_hours(row_number() OVER (PARTITION BY symbol, imbalance_side ORDER BY bar_time)) AS island FROM side) {_STACK.format(k=2)}""",
    lambda s, d: O.stacked_imbalances(_bars(s, d), min_bars=2, strict_micros=FIXED_MICROS["1h"]),
)
_W20 = "OVER (PARTITION BY symbol ORDER BY bar_time ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
_register(
    "delta_divergence",
    f"""{_with_bars()}, {_FLOW}, p AS (SELECT symbol, bar_time, close, cumulative_delta, max(close) {_W20} AS hi, min(close) {_W20} AS lo, max(cumulative_delta) {_W20} AS dhi, min(cumulative_delta) {_W20} AS dlo FROM flow)
SELECT * FROM (SELECT symbol, bar_time, close, cumulative_delta, close > hi AND cumulative_delta <= dhi AS bearish_divergence, close < lo AND cumulative_delta >= dlo AS bullish_divergence FROM p WHERE hi IS NOT NULL) WHERE bearish_divergence OR bullish_divergence""",
    lambda s, d: O.delta_divergence(O.orderflow(_bars(s, d), exact=True)),
)
_register(
    "absorption_candidates",
    f"""{_with_bars()}, q AS (SELECT symbol, bar_time, close, volume, high - low AS bar_range, quantile_cont(volume, 0.9) OVER w AS vq, quantile_cont(high - low, 0.5) OVER w AS rq FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_time ROWS BETWEEN 43200 PRECEDING AND CURRENT ROW))
SELECT symbol, bar_time, close, volume, bar_range, true AS absorption_candidate FROM q WHERE volume >= vq AND bar_range <= rq""",
    lambda s, d: V.absorption_candidates(_bars(s, d)),
)
_register(
    "iceberg_candidates",
    f"""WITH {_with_ticks("events")} SELECT symbol, price, is_buyer_maker, time_bucket(INTERVAL '1 day', ts) AS bucket_time, count(*)::BIGINT AS n_trades, {_d("qty")} AS total_qty, round(stddev_pop(qty), 6) AS qty_stddev FROM ticks GROUP BY ALL HAVING count(*) >= 2""",
    lambda s, d: O.iceberg_candidates(_ticks("events", s, d), window_seconds=86_400, min_repeats=2, exact=True).withColumn("qty_stddev", F.round("qty_stddev", 6)),
)


def _footprint_sql(interval: str) -> str:
    buy, sell = _d("CASE WHEN is_buyer_maker THEN 0 ELSE qty END"), _d("CASE WHEN is_buyer_maker THEN qty ELSE 0 END")
    return f"""WITH {_with_ticks("events")} SELECT symbol, {_start(interval)} AS bar_time, floor(price / 10.0::DOUBLE) * 10.0::DOUBLE AS price_bin, {buy} AS buy_volume, {sell} AS sell_volume, {buy} - {sell} AS delta, {_d("qty")} AS total_volume, count(*)::BIGINT AS trade_count FROM ticks GROUP BY ALL"""


_register("footprint_1min", _footprint_sql("1min"), lambda s, d: P.footprint(_ticks("events", s, d), exact=True))
_register("footprint_1h", _footprint_sql("1h"), lambda s, d: P.footprint(_ticks("events", s, d), "1h", exact=True))
_register("footprint_rollup_4h", _footprint_sql("4h"), lambda s, d: P.footprint_rollup(P.footprint(_ticks("events", s, d), exact=True), "4h", exact=True))
_register("session_histogram", f"WITH {_with_ticks('events')}, {_HIST} SELECT * FROM hist", lambda s, d: P.session_histogram(_ticks("events", s, d), exact=True))
_register("session_range", f"WITH {_with_ticks('events')}, {_RANGE} SELECT * FROM ranges", lambda s, d: P.session_range(_ticks("events", s, d), exact=True))
_register("value_area", f"WITH RECURSIVE {_with_ticks('events')}, {_HIST}, {_AREA} SELECT * FROM area", lambda s, d: P.value_area(P.session_histogram(_ticks("events", s, d), exact=True)))
_register(
    "session_volume_profile",
    f"""WITH RECURSIVE {_with_ticks("events")}, {_HIST}, {_AREA}, q AS (SELECT symbol, session, quantile_cont(volume, 0.9) AS hq, quantile_cont(volume, 0.1) AS lq FROM hist GROUP BY ALL)
SELECT h.symbol, h.session, price_bin, volume, price_bin = poc AS is_poc, price_bin BETWEEN val AND vah AS in_value_area, volume >= hq AS is_hvn, volume <= lq AS is_lvn
FROM hist h JOIN area a ON h.symbol = a.symbol AND h.session = a.session JOIN q ON h.symbol = q.symbol AND h.session = q.session""",
    lambda s, d: P.session_volume_profile(P.session_histogram(_ticks("events", s, d), exact=True)),
)
_register(
    "session_profile_summary",
    f"""WITH RECURSIVE {_with_ticks("events")}, {_HIST}, {_RANGE}, {_AREA} SELECT a.symbol, a.session, poc, vah, val, day_low, day_high, day_volume,
  NOT EXISTS (SELECT 1 FROM ranges l WHERE l.symbol = a.symbol AND l.session > a.session AND a.poc BETWEEN l.day_low AND l.day_high) AS is_poc_naked_as_of_latest_session
FROM area a JOIN ranges r ON a.symbol = r.symbol AND a.session = r.session""",
    lambda s, d: P.profile_summary(P.session_histogram(_ticks("events", s, d), exact=True), P.session_range(_ticks("events", s, d), exact=True)),
)

_DEV = f"""step AS (SELECT symbol, CAST(date_trunc('day', ts) AS TIMESTAMP) AS session, time_bucket(INTERVAL '15 minutes', ts) AS step_time, floor(price / 10.0::DOUBLE) * 10.0::DOUBLE AS price_bin, {_d("qty")} AS v FROM ticks GROUP BY ALL)"""
_register(
    "developing_poc",
    f"""WITH {_with_ticks("events")}, {_DEV}, r AS (SELECT *, {_over("v", "PARTITION BY symbol, session, price_bin ORDER BY step_time")} AS running_volume FROM step)
SELECT symbol, session, step_time, price_bin AS developing_poc, running_volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol, session, step_time ORDER BY running_volume DESC, price_bin) AS k FROM r) WHERE k = 1""",
    lambda s, d: P.developing_poc(_ticks("events", s, d), exact=True),
)
_register(
    "developing_poc_all_bins",
    f"""WITH {_with_ticks("events")}, {_DEV}, t AS (SELECT DISTINCT symbol, session, step_time FROM step),
r AS (SELECT t.symbol, t.session, t.step_time, s.price_bin, {_d("s.v")} AS running_volume FROM t JOIN step s ON s.symbol = t.symbol AND s.session = t.session AND s.step_time <= t.step_time GROUP BY ALL)
SELECT symbol, session, step_time, price_bin AS developing_poc, running_volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol, session, step_time ORDER BY running_volume DESC, price_bin) AS k FROM r) WHERE k = 1""",
    lambda s, d: P.developing_poc(_ticks("events", s, d), traded_only=False, exact=True),
)

_register(
    "validation_report",
    f"""WITH raw AS ({_SQL_TICKS["events"]}), shifted AS (SELECT * REPLACE (trade_id + trade_id // 7 AS trade_id) FROM raw), r AS (SELECT *, epoch_us(ts) * 1000 AS ns FROM shifted), dup AS (SELECT *, trade_id * 2 AS o FROM r UNION ALL SELECT symbol, trade_id, CASE WHEN trade_id % 2 = 0 THEN price ELSE price + 1 END, qty, quote_qty, ts, is_buyer_maker, ns, trade_id * 2 + 1 FROM r WHERE trade_id % 50 < 2),
p AS (SELECT *, lag(price) OVER w AS pp, lag(qty) OVER w AS pq, lag(trade_id) OVER w AS pi, lag(ns) OVER w AS pt, lag(is_buyer_maker) OVER w AS pm FROM dup WINDOW w AS (ORDER BY o))
SELECT symbol, count(*)::BIGINT AS rows_seen, count(*) FILTER (price <= 0 OR qty <= 0)::BIGINT AS n_price_qty_anomalies, count(*) FILTER (ns < pt)::BIGINT AS n_non_monotonic_time,
  count(*) FILTER (trade_id - pi > 1)::BIGINT AS n_id_gaps, coalesce(sum(trade_id - pi - 1) FILTER (trade_id - pi > 1), 0)::BIGINT AS n_missing_ids, count(*) FILTER (trade_id = pi)::BIGINT AS n_duplicate_trade_ids,
  count(*) FILTER (trade_id = pi AND price = pp AND qty = pq AND is_buyer_maker = pm)::BIGINT AS n_duplicate_rows, count(*) FILTER (trade_id = pi AND NOT (price = pp AND qty = pq AND is_buyer_maker = pm))::BIGINT AS n_conflicting_duplicate_trade_ids,
  count(*) FILTER (pp > 0 AND abs((price - pp) / pp) > 0.05)::BIGINT AS n_abnormal_price_jumps, min(trade_id) AS min_trade_id, max(trade_id) AS max_trade_id, min(ns) AS min_trade_time_ns, max(ns) AS max_trade_time_ns FROM p GROUP BY symbol""",
    lambda s, d: Q.validation_report(_damaged(events_as_ticks(s, d))),
)


def _damaged(ticks: DataFrame, gaps: bool = True) -> DataFrame:
    """All ticks, with ids moved apart here and there (if gaps) and, after some, a repetition that is equal or in conflict."""
    rows = ticks.withColumn("trade_id", F.expr("trade_id + trade_id div 7")) if gaps else ticks
    again = rows.where("trade_id % 50 < 2").withColumn("price", F.when(F.col("trade_id") % 2 == 0, F.col("price")).otherwise(F.col("price") + 1))
    return rows.withColumn("source_row", F.col("trade_id") * 2).unionByName(again.withColumn("source_row", F.col("trade_id") * 2 + 1))


#: Without gaps in the ids.
_register("validation_report_whole", ORACLES["validation_report"].replace("trade_id + trade_id // 7 AS trade_id", "trade_id AS trade_id"), lambda s, d: Q.validation_report(_damaged(events_as_ticks(s, d), gaps=False)))
_register(
    "duplicate_ids",
    "SELECT 'LIN' AS symbol, l_orderkey * 8 + l_linenumber AS trade_id, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    lambda s, d: Q.duplicate_ids(s.read.parquet(f"{d}/lineitem.parquet").select(F.lit("LIN").alias("symbol"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("trade_id"))),
)


def _months_done(spark: SparkSession, folder: str) -> DataFrame:
    """The first months of all quarters with orders."""
    return spark.read.parquet(f"{folder}/orders.parquet").select(F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy-MM").alias("year_month")).distinct()


_DONE = "done AS (SELECT DISTINCT strftime(date_trunc('quarter', o_orderdate), '%Y-%m') AS year_month FROM orders)"
_register(
    "month_continuity",
    f"WITH {_DONE}, every AS (SELECT strftime(unnest(generate_series(DATE '1992-01-01', (SELECT CAST(max(year_month) || '-01' AS DATE) FROM done), INTERVAL 1 MONTH)), '%Y-%m') AS year_month) SELECT year_month FROM every WHERE year_month NOT IN (SELECT year_month FROM done)",
    lambda s, d: Q.missing_months(_months_done(s, d), "1992-01"),
)
_register("next_month", f"WITH {_DONE} SELECT strftime(CAST(max(year_month) || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS next_month FROM done", lambda s, d: Q.next_month(_months_done(s, d), "1992-01"))
_register(
    "valid_ticks",
    f"WITH raw AS ({_SQL_TICKS['events']}) SELECT symbol, CAST(date_trunc('day', ts) AS TIMESTAMP) AS session, count(*)::BIGINT AS n FROM raw WHERE price > 0 AND qty > 0 GROUP BY ALL",
    lambda s, d: _ticks("events", s, d).groupBy("symbol", F.date_trunc("day", F.timestamp_micros((F.col("trade_time_ns") / 1000).cast("long"))).alias("session")).agg(F.count(F.lit(1)).alias("n")),
)
_register(
    "timestamp_units",
    "SELECT event_id, CASE WHEN raw >= 1000000000000000 THEN raw * 1000 ELSE raw * 1000000 END AS trade_time_ns FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) ELSE epoch_us(ts) // 1000 END AS raw FROM events)",
    lambda s, d: events_as_ticks(s, d).select(F.col("trade_id").alias("event_id"), raw_to_ns(F.expr("CASE WHEN trade_id % 2 = 0 THEN trade_time_ns div 1000 ELSE trade_time_ns div 1000000 END")).alias("trade_time_ns")),
)


# --- the default path: sums of doubles, in any order --------------------------


def _near(name: str, sql: str, f: Query) -> None:
    """Registers a query whose doubles are rounded to six places on both sides."""

    def rounded(spark: SparkSession, folder: str) -> DataFrame:
        out = f(spark, folder)
        return out.withColumns({c: F.round(c, 6) for c, t in out.dtypes if t == "double"})

    _register(name, f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in _DOUBLES[name])}) FROM ({sql})", rounded)


_BAR_DOUBLES = ("open", "high", "low", "close", "volume", "quote_volume", "vwap", "taker_buy_volume", "taker_sell_volume", "avg_trade_size", "max_trade_size")
_DOUBLES = {
    "bars_double_1h": _BAR_DOUBLES,
    "orderflow_double_1h": (*_BAR_DOUBLES, "delta", "taker_buy_ratio", "cumulative_delta", "session_cumulative_delta"),
    "footprint_double_1h": ("price_bin", "buy_volume", "sell_volume", "delta", "total_volume"),
    "session_range_double": ("day_low", "day_high", "day_volume"),
}
_near("bars_double_1h", ORACLES["bars_1h"], lambda s, d: B.bars(_ticks("events", s, d), "1h"))
_near("orderflow_double_1h", ORACLES["orderflow_1h"], lambda s, d: O.orderflow(B.bars(_ticks("events", s, d), "1h")))
_near("footprint_double_1h", ORACLES["footprint_1h"], lambda s, d: P.footprint(_ticks("events", s, d), "1h"))
_near("session_range_double", ORACLES["session_range"], lambda s, d: P.session_range(_ticks("events", s, d)))


# --- archives --------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> Path:
    """A new folder for files that executors read too: below spark.checkpoint.dir, where it is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    out = Path(tempfile.mkdtemp(prefix="tickforge-") if not base else f"{base.removeprefix('file://')}/tickforge-{uuid.uuid4().hex}") / name
    out.mkdir(parents=True)
    return out


def _as_archives(spark: SparkSession, folder: str) -> list[str]:
    """All events as two monthly archives of one symbol: a zip with a header and milliseconds, and a CSV without and with microseconds."""
    rows = events_as_ticks(spark, folder).select("trade_id", "price", "qty", "quote_qty", F.expr("trade_time_ns div 1000").alias("us"), "is_buyer_maker").orderBy("trade_id")
    out = _folder(spark, "inbox")
    plain, packed = out / "EVT-trades-2024-02.csv", out / "EVT-trades-2024-01.zip"
    with plain.open("w") as a, zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z, z.open("EVT-trades-2024-01.csv", "w", force_zip64=True) as b:
        b.write(b"id,price,qty,quote_qty,time,is_buyer_maker\n")
        for r in rows.toLocalIterator():
            rest = f"{r.trade_id},{r.price!r},{r.qty!r},{r.quote_qty!r}"
            if r.trade_id % 2:
                a.write(f"{rest},{r.us},{str(r.is_buyer_maker).lower()}\n")
            else:
                b.write(f"{rest},{r.us // 1000},{r.is_buyer_maker}\n".encode())
    return [str(packed), str(plain)]


_ARCHIVES = f"""raw AS ({_SQL_TICKS["events"]}), t AS (SELECT symbol, trade_id, price, qty, quote_qty, (CASE WHEN trade_id % 2 = 0 THEN epoch_us(ts) // 1000 * 1000000 ELSE epoch_us(ts) * 1000 END)::BIGINT AS trade_time_ns, is_buyer_maker,
  row_number() OVER (PARTITION BY trade_id % 2 ORDER BY trade_id) - 1 AS source_row, CASE WHEN trade_id % 2 = 0 THEN 'EVT-trades-2024-01.zip' ELSE 'EVT-trades-2024-02.csv' END AS source_file FROM raw)"""
_register("archive_ticks", f"WITH {_ARCHIVES} SELECT * FROM t", lambda s, d: read_archives(s, _as_archives(s, d), "EVT"))
_register(
    "archive_report",
    f"""WITH {_ARCHIVES} SELECT source_file, count(*)::BIGINT AS rows_seen, count(*) FILTER (gap > 1)::BIGINT AS n_id_gaps, sum(gap - 1) FILTER (gap > 1)::BIGINT AS n_missing_ids
FROM (SELECT *, trade_id - lag(trade_id) OVER (PARTITION BY source_file ORDER BY source_row) AS gap FROM t) GROUP BY source_file""",
    lambda s, d: Q.validation_report(read_archives(s, _as_archives(s, d), "EVT")).select("source_file", "rows_seen", "n_id_gaps", "n_missing_ids"),
)


# --- the whole life of archives: inbox, ledger, ticks, bars -------------------


def _ingested(spark: SparkSession, folder: str) -> Config:
    """Both archives of all events taken in, month by month."""
    inbox = Path(_as_archives(spark, folder)[0]).parent
    config = Config(symbol="EVT", start_month="2024-01", inbox=inbox, warehouse=inbox.parent / "warehouse", intervals=("1h", "1d"), min_free_disk_gb=0.1)
    for part in (config.warehouse, config.ticks, config.reports):
        part.mkdir(parents=True, exist_ok=True)
    ingest.run(spark, config)
    return config


def _ledger_rows(spark: SparkSession, config: Config) -> DataFrame:
    ledger = Ledger(config.ledger)
    names = ("year_month", "status", "checkpoint", "verification_status", "rows_seen", "rows_rejected", "rows_written", "n_id_gaps", "n_missing_ids", "min_trade_id", "max_trade_id")
    rows = [tuple(r[c] for c in names) for r in ledger.months(config.symbol)]
    ledger.close()
    return spark.createDataFrame(rows, ", ".join(f"{c} {'string' if k < 4 else 'long'}" for k, c in enumerate(names)))


_INGESTED = f"raw0 AS ({_SQL_TICKS['events']}), raw AS (SELECT * REPLACE (CASE WHEN trade_id % 2 = 0 THEN date_trunc('millisecond', ts) ELSE ts END AS ts) FROM raw0), ticks AS (SELECT * FROM raw WHERE price > 0 AND qty > 0)"
_DOUBLES["ingested_bars_1d"] = _BAR_DOUBLES
_near("ingested_bars_1d", f"WITH {_INGESTED} {_bars_select('1d')}", lambda s, d: warehouse.current(s, _ingested(s, d).warehouse / "bars" / "1d").select(*BARS.names))
_register(
    "ingested_months",
    f"""WITH {_ARCHIVES}, g AS (SELECT *, trade_id - lag(trade_id) OVER (PARTITION BY source_file ORDER BY source_row) AS gap FROM t)
SELECT substr(source_file, 12, 7) AS year_month, 'done' AS status, 'reported' AS checkpoint, 'verified' AS verification_status, count(*)::BIGINT AS rows_seen, count(*) FILTER (NOT (price > 0 AND qty > 0))::BIGINT AS rows_rejected,
  count(*) FILTER (price > 0 AND qty > 0)::BIGINT AS rows_written, count(*) FILTER (gap > 1)::BIGINT AS n_id_gaps, coalesce(sum(gap - 1) FILTER (gap > 1), 0)::BIGINT AS n_missing_ids,
  min(trade_id) FILTER (price > 0 AND qty > 0) AS min_trade_id, max(trade_id) FILTER (price > 0 AND qty > 0) AS max_trade_id FROM g GROUP BY source_file""",
    lambda s, d: _ledger_rows(s, _ingested(s, d)),
)
#: The sketch's quantile, at a place where no neighbour by rank has another value.
_register(
    "large_trades_sketch",
    f"""WITH {_with_ticks("events")} SELECT symbol, trade_id, price, qty, quote_qty, epoch_us(ts) * 1000 AS trade_time_ns, is_buyer_maker FROM ticks WHERE qty >= (SELECT quantile_disc(qty, 0.955) FROM ticks)""",
    lambda s, d: O.large_trades(_ticks("events", s, d), 0.955),
)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars of the events."""
    return QUERIES["bars_1h"](spark, folder)
