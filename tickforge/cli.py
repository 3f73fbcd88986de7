"""python -m tickforge.cli --config FILE --stage discover|ingest|bars|features | --status | --delete-source YYYY-MM"""

from __future__ import annotations

import argparse
import logging
import logging.handlers
import sys
from pathlib import Path

from tickforge import config as C
from tickforge.plans import ingest, warehouse
from tickforge.plans.ledger import Ledger, missing, next_required
from tickforge.sources.layout import scan_inbox, unrecognized


def set_up_logging(folder: Path, level: str = "INFO") -> logging.Logger:
    """Console and a rotating file; once."""
    log = logging.getLogger("tickforge")
    if not log.handlers:
        folder.mkdir(parents=True, exist_ok=True)
        log.setLevel(level)
        for h in (logging.StreamHandler(), logging.handlers.RotatingFileHandler(folder / "tickforge.log", maxBytes=25 << 20, backupCount=5)):
            h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
            log.addHandler(h)
    return log


def status(config: C.Config) -> list[str]:
    """One line for each month, then coverage, sums, what comes next and what is missing."""
    ledger = Ledger(config.ledger)
    try:
        wide = "{:<8} {:<16} {:<19} {:<20} {:>16}".format
        rows = [wide(r["year_month"], r["status"], r["checkpoint"] or "-", r["verification_status"] or "-", f"{r['rows_written'] or 0:,}") for r in ledger.months(config.symbol)]
        total, gaps = ledger.totals(config.symbol), missing(ledger, config.symbol, config.start_month)
        out = [wide("month", "status", "checkpoint", "verification", "rows"), *rows] if rows else ["no month yet"]
        if total["months"]:
            out.append(f"done: {total['months']} months, {total['first_month']} to {total['last_month']}, {total['rows_written']:,} rows")
        return [*out, f"next: {next_required(ledger, config.symbol, config.start_month)}; missing: {', '.join(gaps) or 'none'}"]
    finally:
        ledger.close()


def discover(config: C.Config) -> list[str]:
    ledger = Ledger(config.ledger)
    out = [f"{f.path.name}: {ingest.verified_source(ledger, f.path).status}" for f in scan_inbox(config.inbox, config.symbol)]
    out += [f"{p.name}: not an archive's name" for p in unrecognized(config.inbox)]
    ledger.close()
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tickforge", description=__doc__)
    p.add_argument("--config", required=True)
    p.add_argument("--stage", choices=["discover", "ingest", "bars", "features"], default="ingest")
    p.add_argument("--status", action="store_true")
    p.add_argument("--delete-source", metavar="YYYY-MM")
    p.add_argument("--force", action="store_true")
    a = p.parse_args(argv)
    config = C.load(a.config)
    log = set_up_logging(config.warehouse / "logs")
    if a.status or a.stage == "discover" and not a.delete_source:
        print("\n".join(status(config) if a.status else discover(config)))
        return 0
    ledger = Ledger(config.ledger)
    if a.delete_source:
        there = ingest.delete_source(config, ledger, a.delete_source)
        log.info("source of %s %s", a.delete_source, "deleted" if there else "was not there")
        return 0
    from tickforge.session import local

    spark = local()
    if a.stage == "ingest":
        results = ingest.run(spark, config, a.force)
        for r in results:
            log.info("%s: %s %s", r.year_month, r.status, r.detail)
        return int(any(r.status != "done" for r in results))
    ticks = warehouse.ticks_of(spark, ingest.done_paths(config, ledger))
    if ticks is None:
        log.warning("no month is done")
        return 0
    if a.stage == "bars":
        warehouse.build_bars(spark, config, ticks)
        return 0
    bars = {i: b for i in config.intervals if (b := warehouse.current(spark, config.warehouse / "bars" / i)) is not None}
    if not bars:
        bars = warehouse.build_bars(spark, config, ticks)
    for name, df in warehouse.features(config, ticks, bars).items():
        warehouse.publish(df, config.warehouse / "features" / name, sort=warehouse.table_order(df))
    return 0


if __name__ == "__main__":
    sys.exit(main())
