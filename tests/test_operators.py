"""Hand-made cases: one rule each."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.scalar import raw_to_ns
from tickforge.operators import bars as B
from tickforge.operators import orderflow as O
from tickforge.operators import profile as P
from tickforge.operators import quality as Q
from tickforge.operators import volatility as V
from tickforge.operators.vwap import session_vwap
from tickforge.schemas import BARS, INTERVALS, TICKS

H = 3_600_000_000_000
T0 = 1_704_067_200_000_000_000  # 2024-01-01, a Monday


def tick(i, price, qty=1.0, t=T0, maker=False, symbol="A"):
    return (symbol, i, float(price), float(qty), float(price) * float(qty), t, maker)


def ticks(spark, rows):
    return spark.createDataFrame(rows, TICKS)


def bar(i, close, buy=1.0, sell=1.0, symbol="A", high=None, low=None, volume=None):
    high, low = close + 1 if high is None else high, close - 1 if low is None else low
    return (symbol, pd.Timestamp(T0 + i * H).to_pydatetime(), close, high, low, close, volume if volume is not None else buy + sell, close * (buy + sell), close, buy, sell, 1, buy + sell, buy + sell)


def bar_table(spark, rows):
    return spark.createDataFrame([tuple(float(v) if isinstance(v, int) and k not in (11,) else v for k, v in enumerate(r)) for r in rows], BARS)


def test_ties_go_by_trade_id(spark):
    rows = [tick(3, 30), tick(1, 10), tick(2, 20)]
    for order in (rows, rows[::-1]):
        r = B.bars(ticks(spark, order).repartition(3), "1s").first()
        assert (r.open, r.close, r.high, r.low, r.trade_count) == (10, 30, 30, 10, 3)


def test_invalid_ticks_are_dropped(spark):
    bad = [tick(i, p, q) for i, (p, q) in enumerate([(math.nan, 1), (0, 1), (-1, 1), (1, math.nan), (1, 0)])]
    assert B.valid_ticks(ticks(spark, [*bad, tick(9, 1)])).count() == 1


def test_bucket_edges_and_no_gap_filling(spark):
    rows = [tick(1, 1, t=T0 + H - 1000), tick(2, 2, t=T0 + H), tick(3, 3, t=T0 + 3 * H)]
    assert [r.bar_time.hour for r in B.bars(ticks(spark, rows), "1h").orderBy("bar_time").collect()] == [0, 1, 3]
    week = [tick(1, 1, t=T0 - 1000), tick(2, 2, t=T0)]
    assert [str(r.bar_time.date()) for r in B.bars(ticks(spark, week), "1w").orderBy("bar_time").collect()] == ["2023-12-25", "2024-01-01"]
    assert B.bars(ticks(spark, week), "1mo").count() == 2
    with pytest.raises(ValueError):
        B.bars(ticks(spark, week), "7min")


def random_ticks(spark, n=400, seed=3):
    r = random.Random(seed)
    t = T0
    rows = []
    for i in range(n):
        t += r.choice([0, 1000, 500_000_000, 90_000_000_000, 3 * H])
        rows.append(tick(i, r.randint(90, 130) + r.randint(0, 3) / 4, r.randint(1, 9) / 2, t, r.random() < 0.4, r.choice("AB")))
    return ticks(spark, rows)


def test_cascade_equals_direct(spark):
    t = random_ticks(spark)
    made = B.cascade(t, exact=True)
    for i in INTERVALS:
        assert sorted(map(tuple, made[i].collect())) == sorted(map(tuple, B.bars(t, i, exact=True).collect())), i


def test_bar_properties(spark):
    t = random_ticks(spark, seed=5)
    total = t.agg(F.sum("qty")).first()[0]
    for i in ("1s", "1h", "1mo"):
        b = B.bars(t, i, exact=True).toPandas()
        assert abs(b.volume.sum() - total) < 1e-9
        assert ((b.low <= b.open) & (b.close <= b.high) & (b.low <= b.vwap) & (b.vwap <= b.high)).all()
        assert ((b.taker_buy_volume + b.taker_sell_volume - b.volume).abs() < 1e-9).all()


def test_symbols_stay_apart(spark):
    both = random_ticks(spark)
    for f in (lambda t: O.orderflow(B.bars(t, "1h")), lambda t: P.profile_summary(P.session_histogram(t), P.session_range(t)), lambda t: session_vwap(B.bars(t, "1min"))):
        alone = [x for s in "AB" for x in map(tuple, f(both.where(F.col("symbol") == s)).collect())]
        assert sorted(map(str, map(tuple, f(both).collect()))) == sorted(map(str, alone))


def test_orderflow_sums(spark):
    f = O.orderflow(B.bars(random_ticks(spark), "1h", exact=True), exact=True).toPandas().sort_values("bar_time")
    for _, g in f.groupby("symbol"):
        assert (g.cumulative_delta - g.delta.cumsum()).abs().max() < 1e-9
        assert (g.session_cumulative_delta - g.groupby(g.bar_time.dt.date).delta.cumsum()).abs().max() < 1e-9


def test_stacked_imbalances(spark):
    sides = ["b", "-", "b", "b", "s", "b"]
    rows = [bar(i, 10, *{"b": (9, 1), "s": (1, 9), "-": (1, 1)}[s]) for i, s in enumerate(sides)]
    got = O.stacked_imbalances(bar_table(spark, rows)).orderBy("bar_time").collect()
    assert [(r.bar_time.hour, r.island_length) for r in got] == [(0, 3), (2, 3), (3, 3)]
    strict = O.stacked_imbalances(bar_table(spark, rows), min_bars=2, strict_micros=H // 1000).collect()
    assert sorted(r.bar_time.hour for r in strict) == [2, 3]
    # the other side at 0: no imbalance
    assert O.stacked_imbalances(bar_table(spark, [bar(i, 10, 5, 0) for i in range(4)])).count() == 0


def test_divergence_on_a_partial_frame(spark):
    rows = [bar(0, 10, 5, 1), bar(1, 9, 5, 1), bar(2, 12, 1, 9)]
    got = O.delta_divergence(O.orderflow(bar_table(spark, rows))).orderBy("bar_time").collect()
    assert [(r.bar_time.hour, r.bearish_divergence, r.bullish_divergence) for r in got] == [(1, False, True), (2, True, False)]


def histogram(spark, volumes):
    return spark.createDataFrame([("A", pd.Timestamp("2024-01-01").to_pydatetime(), float(10 * k), float(v)) for k, v in enumerate(volumes)], "symbol string, session timestamp, price_bin double, volume double")


#: Volumes by bin (edges 0, 10, 20, ...), then the point of control, the upper and the lower edge, worked out by hand.
AREAS = [
    ([5], (0, 0, 0)),
    ([1, 5, 5, 1], (10, 20, 10)),  # the first of two peaks, then the larger side
    ([9, 1, 1, 1], (0, 0, 0)),  # the peak alone has 75 %
    ([1, 1, 1, 9], (30, 30, 30)),
    ([2, 3, 2, 3, 2], (10, 40, 10)),  # equal sides: up, each time
    ([1, 2, 9, 2, 1, 0.5, 4], (20, 40, 10)),  # up, down, up
    ([4, 1, 1], (0, 10, 0)),  # nothing below
]


@pytest.mark.parametrize(("volumes", "want"), AREAS)
def test_value_area(spark, volumes, want):
    assert tuple(P.value_area(histogram(spark, volumes)).first()[2:]) == want


@pytest.mark.parametrize("seed", range(4))
def test_value_area_is_no_larger_than_needed(spark, seed):
    v = np.random.default_rng(seed).integers(1, 50, 30).astype(float)
    poc, top, bottom = (int(x) // 10 for x in P.value_area(histogram(spark, v)).first()[2:])
    inside = v[bottom : top + 1].sum()
    assert poc == v.argmax() and bottom <= poc <= top and inside >= 0.7 * v.sum()
    # one of the ends was the last to come, and without it the share was missed
    assert min(inside - v[bottom], inside - v[top]) < 0.7 * v.sum() or bottom == top


def test_nodes_use_interpolated_quantiles(spark):
    v = list(range(1, 12))
    got = P.session_volume_profile(histogram(spark, v)).toPandas().sort_values("price_bin")
    assert got.is_hvn.tolist() == [x >= 10 for x in v] and got.is_lvn.tolist() == [x <= 2 for x in v]
    assert P.session_volume_profile(histogram(spark, [3])).first().is_hvn


def test_naked_points_of_control(spark):
    day = 24 * H
    rows = [tick(1, 105), tick(2, 105), tick(3, 150, t=T0 + day), tick(4, 100, t=T0 + 2 * day), tick(5, 120, t=T0 + 2 * day)]
    t = ticks(spark, rows)
    got = P.profile_summary(P.session_histogram(t), P.session_range(t)).orderBy("session").collect()
    # 100 is touched by the third day's low; 150 never; the last session always is naked
    assert [r.is_poc_naked_as_of_latest_session for r in got] == [False, True, True]


def test_developing_poc(spark):
    m = 15 * 60 * 10**9
    rows = [tick(1, 105, 9), tick(2, 205, 1, T0 + m), tick(3, 205, 2, T0 + 2 * m)]
    step = P.developing_poc(ticks(spark, rows)).orderBy("step_time").collect()
    assert [(r.developing_poc, r.running_volume) for r in step] == [(100, 9), (200, 1), (200, 3)]
    whole = P.developing_poc(ticks(spark, rows), traded_only=False).orderBy("step_time").collect()
    assert [(r.developing_poc, r.running_volume) for r in whole] == [(100, 9), (100, 9), (100, 9)]


def test_footprint_rolls_up(spark):
    t = random_ticks(spark)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(P.footprint_rollup(P.footprint(t, exact=True), "1h", exact=True)) == key(P.footprint(t, "1h", exact=True))


def test_atr_in_blocks(spark):
    r = random.Random(1)
    rows = [bar(i, 100 + r.random() * 9, symbol=s) for s in "AB" for i in range(57)]
    whole = V.atr(bar_table(spark, rows)).toPandas().sort_values(["symbol", "bar_time"])
    parts = V.atr(bar_table(spark, rows), block=7).toPandas().sort_values(["symbol", "bar_time"])
    assert (whole.atr.to_numpy() - parts.atr.to_numpy()).__abs__().max() < 1e-9
    g = whole[whole.symbol == "A"]
    assert g.atr.iloc[0] == g.true_range.iloc[0] and abs(g.atr.iloc[1] - (13 * g.true_range.iloc[0] + g.true_range.iloc[1]) / 14) < 1e-9
    assert V.atr(bar_table(spark, [bar(0, 10)])).count() == 0


def test_realized_vol(spark):
    got = V.realized_volatility(bar_table(spark, [bar(i, 50) for i in range(4)])).orderBy("bar_time").collect()
    assert [(r.log_return, r.realized_vol) for r in got] == [(0, None), (0, 0), (0, 0)]


def test_absorption_in_blocks(spark):
    r = random.Random(2)
    rows = [bar(i, 100, high=101 + r.random(), low=99.0, volume=r.randint(1, 50)) for i in range(120)]
    p = bar_table(spark, rows).toPandas().sort_values("bar_time")
    for reach in (10, 30):
        want = p[(p.volume >= p.volume.rolling(reach + 1, min_periods=1).quantile(0.9)) & ((p.high - p.low) <= (p.high - p.low).rolling(reach + 1, min_periods=1).quantile(0.5))]
        got = V.absorption_candidates(bar_table(spark, rows), rows=reach, block=13).toPandas().sort_values("bar_time")
        assert got.bar_time.tolist() == want.bar_time.tolist()


def test_iceberg(spark):
    rows = [tick(i, 10, 2, T0 + i * 100_000_000) for i in range(6)] + [tick(9, 10, 1, T0, True)]
    r = O.iceberg_candidates(ticks(spark, rows)).collect()
    assert len(r) == 1 and (r[0].n_trades, r[0].total_qty, r[0].qty_stddev) == (6, 12, 0)


@pytest.mark.parametrize("chunk", [2, 3, 1000])
def test_validation_rules(spark, chunk):
    ids = [1, 2, 4, 4, 4, 3, 9]
    price = [100, 105, 105, 105, 111, 111, 0]
    rows = [(*tick(i, p, t=T0 + k * (1 if k != 3 else -9)), k) for k, (i, p) in enumerate(zip(ids, price, strict=True))]
    r = Q.validation_report(spark.createDataFrame(rows, T.StructType([*TICKS.fields, T.StructField("source_row", T.LongType())])), chunk=chunk).first()
    assert (r.rows_seen, r.n_id_gaps, r.n_missing_ids) == (7, 2, 6)
    assert (r.n_duplicate_trade_ids, r.n_duplicate_rows, r.n_conflicting_duplicate_trade_ids) == (2, 1, 1)
    # 5 % is no jump, more is, as is a fall to 0
    assert (r.n_abnormal_price_jumps, r.n_price_qty_anomalies, r.n_non_monotonic_time) == (2, 1, 1)
    assert (r.min_trade_id, r.max_trade_id) == (1, 9)


def test_raw_times(spark):
    rows = [(10**15,), (1_735_689_600_123,)]
    got = [r[0] for r in spark.createDataFrame(rows, "r long").select(raw_to_ns("r")).collect()]
    assert got == [10**18, 1_735_689_600_123_000_000]


def test_empty_tables(spark):
    t, b = ticks(spark, []), spark.createDataFrame([], BARS)
    for df in (B.bars(t, "1h"), O.orderflow(b), O.large_trades(t), O.stacked_imbalances(b), P.session_volume_profile(P.session_histogram(t)), P.profile_summary(P.session_histogram(t), P.session_range(t)), V.atr(b), V.realized_volatility(b), V.absorption_candidates(b), O.iceberg_candidates(t)):
        assert df.count() == 0 and df.columns


def test_months(spark):
    done = spark.createDataFrame([("2023-11",), ("2024-02",)], "year_month string")
    assert sorted(r[0] for r in Q.missing_months(done, "2023-11").collect()) == ["2023-12", "2024-01"]
    assert Q.next_month(done, "2020-01").first()[0] == "2024-03"
    assert Q.next_month(done.limit(0), "2020-01").first()[0] == "2020-01"
