"""The ledger: where each month stands, and what was verified of each source file.

A small SQLite file that only the driver touches.  A month's row has the three
states that decide what happens next, and one JSON object of facts: whatever
the source check, the counters and the writer had to say.
"""

from __future__ import annotations

import json
import sqlite3
import time
from pathlib import Path

#: Checkpoints of a month, in order.
CHECKPOINTS = ("source_verified", "ticks_written", "ticks_verified", "features_generated", "reported")
STATUSES = ("pending", "in_progress", "done", "failed", "paused_low_disk")
_STATES = ("status", "checkpoint", "verification_status")
#: Facts that are summed over months.
SUMMED = ("rows_seen", "rows_written", "n_id_gaps", "n_missing_ids", "n_duplicate_trade_ids")


class Facts(dict):
    """A month's row; a fact that nobody has stated yet is None."""

    def __missing__(self, key: str):
        return None


class Ledger:
    def __init__(self, path: str | Path):
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        self.db = sqlite3.connect(path, timeout=30, isolation_level=None)
        self.db.execute("PRAGMA journal_mode=WAL")
        self.db.execute("CREATE TABLE IF NOT EXISTS month (symbol, year_month, status DEFAULT 'pending', checkpoint, verification_status, facts DEFAULT '{}', PRIMARY KEY (symbol, year_month))")
        self.db.execute("CREATE TABLE IF NOT EXISTS source (path, size_bytes, mtime, deep, found, PRIMARY KEY (path, size_bytes, mtime, deep))")

    def close(self) -> None:
        self.db.close()

    def months(self, symbol: str | None = None, status: str | None = None) -> list[Facts]:
        rows = self.db.execute("SELECT symbol, year_month, status, checkpoint, verification_status, facts FROM month WHERE coalesce(?, symbol) = symbol AND coalesce(?, status) = status ORDER BY symbol, year_month", (symbol, status))
        return [Facts(symbol=s, year_month=m, **dict(zip(_STATES, states, strict=True)), **json.loads(facts)) for s, m, *states, facts in rows]

    def month(self, symbol: str, year_month: str) -> Facts | None:
        return next((r for r in self.months(symbol) if r["year_month"] == year_month), None)

    def begin(self, symbol: str, year_month: str, source_path: str, source_format: str) -> Facts:
        """The month's row, made where it is not there; its source is what was found now."""
        self.db.execute("INSERT OR IGNORE INTO month (symbol, year_month) VALUES (?, ?)", (symbol, year_month))
        self.update(symbol, year_month, source_path=source_path, source_format=source_format)
        return self.month(symbol, year_month)

    def update(self, symbol: str, year_month: str, **values) -> None:
        """Sets the given states and facts only; the row must be there."""
        states = {k: values.pop(k) for k in _STATES if k in values}
        # a JSON patch takes null for removal, and a fact that is not there reads as None
        patch = json.dumps(values | {"updated_at": time.time()})
        sets = "".join(f"{k} = ?, " for k in states)
        if not self.db.execute(f"UPDATE month SET {sets}facts = json_patch(facts, ?) WHERE symbol = ? AND year_month = ?", (*states.values(), patch, symbol, year_month)).rowcount:
            raise KeyError(f"{symbol} {year_month} is not in the ledger")

    def source(self, path: Path, deep: bool) -> list | None:
        """The fields of the verification of an unchanged file, checked as deep or deeper."""
        s = path.stat()
        row = self.db.execute("SELECT found FROM source WHERE path = ? AND size_bytes = ? AND mtime = ? AND deep >= ? ORDER BY deep DESC", (str(path), s.st_size, s.st_mtime, int(deep))).fetchone()
        return json.loads(row[0]) if row else None

    def put_source(self, path: Path, deep: bool, found: tuple) -> None:
        s = path.stat()
        self.db.execute("INSERT OR REPLACE INTO source VALUES (?, ?, ?, ?, ?)", (str(path), s.st_size, s.st_mtime, int(deep), json.dumps(found)))

    def totals(self, symbol: str) -> dict:
        """Sums over the months that are done."""
        done = self.months(symbol, "done")
        names = [r["year_month"] for r in done]
        return {c: sum(r[c] or 0 for r in done) for c in SUMMED} | {"months": len(done), "first_month": min(names, default=None), "last_month": max(names, default=None)}


def following(year_month: str) -> str:
    y, m = map(int, year_month.split("-"))
    return f"{y + m // 12:04d}-{m % 12 + 1:02d}"


def next_required(ledger: Ledger, symbol: str, start: str) -> str:
    """The month after the latest one done; gaps are reported apart."""
    latest = ledger.totals(symbol)["last_month"]
    return following(latest) if latest else start


def missing(ledger: Ledger, symbol: str, start: str) -> list[str]:
    """Months from start to the latest one done that are not done."""
    done = {r["year_month"] for r in ledger.months(symbol, "done")}
    out, at = [], start
    while done and at <= max(done):
        if at not in done:
            out.append(at)
        at = following(at)
    return out
