"""Bars and features of stored ticks, and writing of tables.

Derived tables are written beside the current version and then pointed at: a
small file names the version that readers use, so a reader never sees half a
table and object stores need no rename.
"""

from __future__ import annotations

import json
import shutil
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tickforge.config import Config
from tickforge.errors import DiskSpaceGuardError
from tickforge.operators import bars as B
from tickforge.operators import orderflow as O
from tickforge.operators import profile as P
from tickforge.operators import volatility as V
from tickforge.operators.vwap import session_vwap
from tickforge.schemas import TICKS


def check_disk(folder: Path, least_gb: float) -> None:
    free = shutil.disk_usage(folder).free / 1e9
    if free < least_gb:
        raise DiskSpaceGuardError(f"{free:.1f} GB free at {folder}, {least_gb} asked for")


@contextmanager
def disk_guard(spark: SparkSession, folder: Path, least_gb: float, every_s: float = 1.0) -> Iterator[None]:
    """Looks at the free disk before the jobs inside and while they run; too little cancels them and raises."""
    check_disk(folder, least_gb)
    tag, done, found = f"guard-{uuid.uuid4().hex}", threading.Event(), []

    def watch() -> None:
        while not done.wait(every_s):
            try:
                check_disk(folder, least_gb)
            except DiskSpaceGuardError as e:
                found.append(e)
                spark.sparkContext.cancelJobsWithTag(tag)
                return

    spark.sparkContext.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield
    except Exception as e:
        if found:
            raise found[0] from e
        raise
    finally:
        done.set()
        watcher.join()
        spark.sparkContext.removeJobTag(tag)
    if found:
        raise found[0]


def size_of(folder: Path) -> int:
    return sum(p.stat().st_size for p in Path(folder).rglob("*") if p.is_file())


def publish(df: DataFrame, folder: Path, partition_by: tuple[str, ...] = ("symbol",), sort: tuple[str, ...] = ()) -> str:
    """Writes a version of a table, in the order of sort, and makes it the current one; returns its path.

    The version before stays for its readers until the next one is written.
    """
    version = f"v-{uuid.uuid4().hex}"
    out = df.sortWithinPartitions(*partition_by, *sort) if sort else df
    out.write.partitionBy(*partition_by).option("compression", "zstd").parquet(str(folder / version))
    pointer = folder / "current.json"
    known = json.loads(pointer.read_text()) if pointer.exists() else {}
    staged = folder / f".{version}.json"
    staged.write_text(json.dumps({"version": version, "before": known.get("version")}))
    staged.replace(pointer)
    if known.get("before"):
        shutil.rmtree(folder / known["before"], ignore_errors=True)
    return str(folder / version)


def table_order(df: DataFrame) -> tuple[str, ...]:
    """The columns that a derived table is sorted by: those of time, price and id that it has."""
    return tuple(c for c in ("session", "bar_time", "step_time", "bucket_time", "trade_time_ns", "price_bin", "price", "trade_id") if c in df.columns)


def current(spark: SparkSession, folder: Path) -> DataFrame | None:
    pointer = folder / "current.json"
    return spark.read.parquet(str(folder / json.loads(pointer.read_text())["version"])) if pointer.exists() else None


def month_folder(config: Config, year_month: str) -> Path:
    return config.ticks / f"symbol={config.symbol}" / f"year_month={year_month}"


def ticks_of(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The ticks of month folders; None without any."""
    return spark.read.schema(TICKS).parquet(*paths) if paths else None


def build_bars(spark: SparkSession, config: Config, ticks: DataFrame) -> dict[str, DataFrame]:
    """All intervals from one scan of the ticks; each state is stored and the next one made of it."""

    def keep(interval: str, state: DataFrame) -> DataFrame:
        publish(state, config.warehouse / "states" / interval)
        return current(spark, config.warehouse / "states" / interval)

    made = B.cascade(ticks, config.intervals, keep=keep)
    for interval, df in made.items():
        publish(df, config.warehouse / "bars" / interval, sort=("bar_time",))
    return {i: current(spark, config.warehouse / "bars" / i) for i in made}


def features(config: Config, ticks: DataFrame, bars: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The feature tables, as plans."""
    f = config.features
    first = bars.get("1min", next(iter(bars.values())))
    hourly = bars.get("1h", next(iter(bars.values())))
    out = {f"orderflow_{i}": O.orderflow(bars[i]) for i in f.orderflow_intervals if i in bars}
    flow = out.get("orderflow_1min") or (next(iter(out.values())) if out else O.orderflow(first))
    histogram = P.session_histogram(ticks, f.bin_size)
    return out | {
        "large_trades": O.large_trades(ticks, f.large_trade_quantile),
        "stacked_imbalances": O.stacked_imbalances(first, f.imbalance_ratio, f.imbalance_bars),
        "delta_divergence": O.delta_divergence(flow, f.divergence_lookback),
        "absorption_candidates": V.absorption_candidates(first, f.absorption_quantile, f.absorption_rows),
        "iceberg_candidates": O.iceberg_candidates(ticks, f.iceberg_seconds, f.iceberg_repeats),
        "session_vwap_1min": session_vwap(first),
        "footprint": P.footprint(ticks, f.footprint_interval, f.bin_size),
        "session_volume_profile": P.session_volume_profile(histogram, f.value_area_share),
        "session_profile_summary": P.profile_summary(histogram, P.session_range(ticks), f.value_area_share),
        "developing_poc": P.developing_poc(ticks, f.bin_size, f.developing_minutes),
        "atr_1h": V.atr(hourly, f.atr_period),
        "realized_vol_1h": V.realized_volatility(hourly, f.realized_vol_window),
    }


def rebuild(spark: SparkSession, config: Config, paths: list[str]) -> list[str]:
    """Bars and features of the given months; the names of the tables written."""
    ticks = ticks_of(spark, paths)
    if ticks is None:
        return []
    bars = build_bars(spark, config, ticks)
    made = features(config, ticks, bars)
    for name, df in made.items():
        publish(df, config.warehouse / "features" / name, sort=table_order(df))
    return [*(f"bars_{i}" for i in bars), *made]
