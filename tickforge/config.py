"""Configuration: frozen values, read from YAML with required keys."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from tickforge.schemas import INTERVALS


@dataclass(frozen=True)
class Features:
    large_trade_quantile: float = 0.99
    value_area_share: float = 0.70
    atr_period: int = 14
    realized_vol_window: int = 30
    imbalance_ratio: float = 3.0
    imbalance_bars: int = 3
    divergence_lookback: int = 20
    absorption_quantile: float = 0.9
    absorption_rows: int = 43_200
    iceberg_seconds: int = 2
    iceberg_repeats: int = 5
    footprint_interval: str = "1min"
    bin_size: float = 10.0
    developing_minutes: int = 15
    orderflow_intervals: tuple[str, ...] = ("1min", "5min", "15min", "1h")


@dataclass(frozen=True)
class Config:
    symbol: str
    start_month: str
    inbox: Path
    warehouse: Path
    intervals: tuple[str, ...] = INTERVALS
    min_free_disk_gb: float = 2.0
    jump: float = 0.05
    row_group_rows: int = 500_000
    features: Features = field(default_factory=Features)

    @property
    def ticks(self) -> Path:
        return self.warehouse / "ticks"

    @property
    def ledger(self) -> Path:
        return self.warehouse / "ledger.sqlite"

    @property
    def reports(self) -> Path:
        return self.warehouse / "reports"


def load(path: str | Path) -> Config:
    """A Config of a YAML file; missing or unknown keys are errors.  Makes the folders."""
    import yaml

    raw = yaml.safe_load(Path(path).read_text()) or {}
    for key in ("symbol", "start_month", "inbox", "warehouse"):
        if key not in raw:
            raise ValueError(f"{path}: {key} is missing")
    features = raw.pop("features", {}) or {}
    known = Features.__dataclass_fields__
    if unknown := set(features) - set(known):
        raise ValueError(f"{path}: unknown features {sorted(unknown)}")
    values = {k: tuple(v) if isinstance(v, list) else type(known[k].default)(v) for k, v in features.items()}
    if unknown := set(raw) - set(Config.__dataclass_fields__):
        raise ValueError(f"{path}: unknown keys {sorted(unknown)}")
    raw |= {"inbox": Path(raw["inbox"]), "warehouse": Path(raw["warehouse"]), "features": Features(**values), "symbol": str(raw["symbol"]), "start_month": str(raw["start_month"])}
    if "intervals" in raw:
        raw["intervals"] = tuple(raw["intervals"])
        if bad := set(raw["intervals"]) - set(INTERVALS):
            raise ValueError(f"{path}: unknown intervals {sorted(bad)}")
    config = Config(**raw)
    for folder in (config.inbox, config.warehouse, config.ticks, config.reports):
        folder.mkdir(parents=True, exist_ok=True)
    return config
