"""The data quality report of a month."""

from __future__ import annotations

import time
from pathlib import Path

from tickforge.config import Config
from tickforge.plans.ledger import Ledger, missing, next_required
from tickforge.plans.warehouse import size_of

#: Share of missing ids above which the report warns.
MISSING_SHARE = 0.001


def _n(value) -> str:
    return "-" if value is None else f"{value:,}"


def warnings(row: dict, gaps: list[str]) -> list[str]:
    out = []
    if row["n_conflicting_duplicate_trade_ids"]:
        out.append(f"{_n(row['n_conflicting_duplicate_trade_ids'])} repeated trade ids have other data than the row before.")
    if (row["n_missing_ids"] or 0) > MISSING_SHARE * (row["rows_seen"] or 0):
        out.append(f"{_n(row['n_missing_ids'])} trade ids are missing, more than {MISSING_SHARE:.1%} of the rows.")
    if row["verification_status"] != "verified":
        out.append("The stored ticks are not verified; the source must stay.")
    if gaps:
        out.append(f"Months before the latest are missing: {', '.join(gaps)}.")
    return out


def _gb(folder: Path | str) -> str:
    return f"{size_of(Path(folder)) / 1e9:.3f} GB"


def _tables(config: Config, kind: str) -> str:
    """Names of the published tables of a kind."""
    return ", ".join(sorted(p.parent.name for p in (config.warehouse / kind).glob("*/current.json"))) or "none"


def report_text(config: Config, ledger: Ledger, month: str) -> str:
    """Markdown: a table of sections, each a list of facts."""
    row, totals, gaps = ledger.month(config.symbol, month), ledger.totals(config.symbol), missing(ledger, config.symbol, config.start_month)
    upcoming = next_required(ledger, config.symbol, config.start_month)
    safe = row["status"] == "done" and row["verification_status"] == "verified"
    side = {None: "not there", True: "matches", False: "differs"}[row["checksum_matched"]]
    sections = {
        "Source": {"File": f"{row['source_path']} ({row['source_format']})", "SHA-256": row["source_sha256"] or "-", "Checksum file": side, "Seconds": f"{row['elapsed_s'] or 0:.1f}"},
        "Rows": {"In the source": _n(row["rows_seen"]), "Rejected (price or quantity)": _n(row["rows_rejected"]), "Stored": _n(row["rows_written"]), "Trade ids": f"{_n(row['min_trade_id'])} to {_n(row['max_trade_id'])}"},
        "Order and gaps": {
            "Gaps in ids": f"{_n(row['n_id_gaps'])}, {_n(row['n_missing_ids'])} ids missing", "Repeated ids": _n(row["n_duplicate_trade_ids"]), "of which equal rows": _n(row["n_duplicate_rows"]),
            "of which conflicts": _n(row["n_conflicting_duplicate_trade_ids"]), "Times out of order": _n(row["n_non_monotonic_time"]), f"Price jumps beyond {config.jump:.1%}": _n(row["n_abnormal_price_jumps"]),
        },
        "Verification of the stored ticks": {"Result": row["verification_status"] or "not verified", "Detail": row["error"] or "schema, row count and range of ids as written", "The source may": "be deleted" if safe else "not be deleted"},
        "Tables": {"Ticks": row["ticks_path"] or "-", "Bars": _tables(config, "bars"), "Features": _tables(config, "features")},
        "Growth": {"Stored size of the month": _gb(row["ticks_path"]) if row["ticks_path"] else "-", "All ticks": _gb(config.ticks), "Warehouse": _gb(config.warehouse), "Months done": totals["months"], "Rows stored": _n(totals["rows_written"])},
        "Continuity": {"Covered": f"{totals['first_month']} to {totals['last_month']}", "Missing": ", ".join(gaps) or "none", "Next": upcoming},
    }
    lines = [f"# Data quality: {config.symbol} {month}", ""]
    for name, facts in sections.items():
        lines += [f"## {name}", "", *(f"- {k}: {v}" for k, v in facts.items()), ""]
    return "\n".join([*lines, "## Warnings", "", *([f"- {w}" for w in warnings(row, gaps)] or ["None."]), ""])


def write_report(config: Config, ledger: Ledger, month: str) -> Path:
    path = config.reports / f"{config.symbol}_{month}_{time.strftime('%Y%m%dT%H%M%S')}.md"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(report_text(config, ledger, month))
    return path
