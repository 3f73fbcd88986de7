"""Ingestion of monthly archives, month by month, resumable at each checkpoint."""

from __future__ import annotations

import logging
import shutil
import time
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.config import Config
from tickforge.errors import CorruptedArchiveError, DiskSpaceGuardError, VerificationFailedError, WrongMarketError
from tickforge.operators.bars import valid_ticks
from tickforge.operators.quality import validation_report
from tickforge.plans import warehouse as W
from tickforge.plans.ledger import CHECKPOINTS, Ledger
from tickforge.plans.report import write_report
from tickforge.sources.archives import read_archives
from tickforge.sources.layout import Archive, Verification, scan_inbox, verify

log = logging.getLogger("tickforge")


@dataclass(frozen=True)
class MonthResult:
    year_month: str
    status: str
    detail: str = ""


def reached(row: dict, checkpoint: str) -> bool:
    at = row["checkpoint"]
    return at is not None and CHECKPOINTS.index(at) >= CHECKPOINTS.index(checkpoint)


def verified_source(ledger: Ledger, path: Path, deep: bool = True) -> Verification:
    """What verification found, from the ledger where the file is unchanged and was checked as deep."""
    if (known := ledger.source(path, deep)) and (found := Verification(*known)).status == "ok":
        return found
    found = verify(path, deep)
    ledger.put_source(path, deep, found)
    return found


def done_paths(config: Config, ledger: Ledger) -> list[str]:
    """Tick folders of the symbol's months that are done and there; a warning names those that are not there."""
    rows = [r for r in ledger.months(config.symbol, "done") if r["ticks_path"]]
    if lost := [r["year_month"] for r in rows if not Path(r["ticks_path"]).exists()]:
        log.warning("%d months are done but their ticks are not there, so they are left out: %s", len(lost), ", ".join(lost))
    return [r["ticks_path"] for r in rows if r["year_month"] not in lost]


def verify_ticks(spark: SparkSession, path: str, row: dict) -> None:
    """Reads a month's ticks again: schema, count and ids must be those of the ledger."""
    df = spark.read.parquet(path)
    if [(f.name, f.dataType) for f in df.schema.fields] != [(f.name, f.dataType) for f in schemas.TICKS.fields]:
        raise VerificationFailedError(f"{path}: schema {df.schema.simpleString()}")
    n, low, high = df.agg(F.count(F.lit(1)), F.min("trade_id"), F.max("trade_id")).first()
    if (n, low, high) != (row["rows_written"], row["min_trade_id"], row["max_trade_id"]):
        raise VerificationFailedError(f"{path}: {n} rows, ids {low} to {high}; {row['rows_written']}, {row['min_trade_id']} to {row['max_trade_id']} were written")


def _ingest(spark: SparkSession, config: Config, ledger: Ledger, file: Archive, sha256: str | None) -> None:
    """Writes a month's ticks and its counters, with an eye on the disk.

    The archive is parsed once, into raw Parquet; its checks and its ticks come
    from there.  Ticks go to a folder of their own, which the ledger then points
    at, so the month's ticks before stay whole until they are replaced.
    """
    key = (config.symbol, file.year_month)
    before = ledger.month(*key)["ticks_path"]
    folder = W.month_folder(config, file.year_month)
    raw, target = folder / f".raw-{uuid.uuid4().hex}", folder / f"v-{uuid.uuid4().hex}"
    try:
        with W.disk_guard(spark, config.warehouse, config.min_free_disk_gb):
            read_archives(spark, [str(file.path)], config.symbol).write.option("compression", "zstd").parquet(str(raw))
            source = spark.read.parquet(str(raw))
            report = validation_report(source, jump=config.jump).first()
            counters = report.asDict() if report else {"rows_seen": 0}
            counters = {k: v for k, v in counters.items() if k not in ("symbol", "source_file")}
            ticks = valid_ticks(source).select(*schemas.TICKS.names).sortWithinPartitions("trade_time_ns", "trade_id")
            ticks.write.option("compression", "zstd").option("parquet.block.row.count.limit", config.row_group_rows).parquet(str(target))
        n, low, high = spark.read.schema(schemas.TICKS).parquet(str(target)).agg(F.count(F.lit(1)), F.min("trade_id"), F.max("trade_id")).first()
    except BaseException:
        shutil.rmtree(target, ignore_errors=True)
        raise
    finally:
        shutil.rmtree(raw, ignore_errors=True)
    counters |= {"rows_written": n, "rows_rejected": counters["rows_seen"] - n, "min_trade_id": low, "max_trade_id": high}
    ledger.update(*key, checkpoint="ticks_written", ticks_path=str(target), verification_status=None, source_sha256=sha256, **counters)
    if before:
        shutil.rmtree(before, ignore_errors=True)


def process(spark: SparkSession, config: Config, ledger: Ledger, file: Archive, force: bool = False) -> MonthResult:
    """Takes one month from its last checkpoint to verified ticks; never raises."""
    began, month, key = time.time(), file.year_month, (config.symbol, file.year_month)
    row = ledger.begin(*key, str(file.path), file.format)
    if not force and row["checkpoint"] == "reported" and row["status"] == "done":
        return MonthResult(month, "done", "already reported")
    try:
        if force or not (reached(row, "ticks_written") and row["ticks_path"] and Path(row["ticks_path"]).exists()):
            found = verified_source(ledger, file.path)
            if found.status != "ok":
                raise (WrongMarketError if found.status == "wrong_market" else CorruptedArchiveError)(f"{file.path.name}: {found.status} {found.detail}")
            versions = {"schema_version": schemas.SCHEMA_VERSION, "feature_version": schemas.FEATURE_VERSION, "software_version": schemas.SOFTWARE_VERSION}
            ledger.update(*key, status="in_progress", checkpoint="source_verified", error=None, checksum_matched=found.checksum_matched, **versions)
            _ingest(spark, config, ledger, file, found.sha256)
            row = ledger.month(*key)
        if row["verification_status"] != "verified":
            try:
                verify_ticks(spark, row["ticks_path"], row)
            except VerificationFailedError:
                # the ticks are no good: the next run starts from the source again
                ledger.update(*key, verification_status="verification_failed", checkpoint="source_verified")
                raise
            ledger.update(*key, checkpoint="ticks_verified", verification_status="verified")
        ledger.update(*key, status="done", elapsed_s=time.time() - began)
    except DiskSpaceGuardError as e:
        ledger.update(*key, status="paused_low_disk", error=str(e))
        return MonthResult(month, "paused_low_disk", str(e))
    except Exception as e:  # noqa: BLE001  the month is marked, the others go on
        ledger.update(*key, status="failed", error=str(e)[:2000])
        return MonthResult(month, "failed", str(e)[:300])
    return MonthResult(month, "done")


def finish(spark: SparkSession, config: Config, ledger: Ledger) -> list[MonthResult]:
    """Bars and features once for all months whose ticks are verified but that are not reported, then their reports."""
    rows = [r for r in ledger.months(config.symbol) if r["verification_status"] == "verified" and r["checkpoint"] in ("ticks_verified", "features_generated")]
    out = []
    try:
        if any(r["checkpoint"] == "ticks_verified" for r in rows):
            for r in rows:
                ledger.update(config.symbol, r["year_month"], status="done")
            W.rebuild(spark, config, done_paths(config, ledger))
        for r in rows:
            key = (config.symbol, r["year_month"])
            ledger.update(*key, status="done", checkpoint="features_generated")
            write_report(config, ledger, r["year_month"])
            ledger.update(*key, checkpoint="reported", error=None)
            out.append(MonthResult(r["year_month"], "done", "resumed"))
    except Exception as e:  # noqa: BLE001  the months keep their checkpoints, so the next run takes them up here
        for r in rows[len(out) :]:
            ledger.update(config.symbol, r["year_month"], status="failed", error=str(e)[:2000])
            out.append(MonthResult(r["year_month"], "failed", str(e)[:300]))
    return out


def run(spark: SparkSession, config: Config, force: bool = False) -> list[MonthResult]:
    """Ingests the inbox month by month, then rebuilds the derived tables once and reports; months that a run before left over are finished too."""
    ledger = Ledger(config.ledger)
    try:
        out: dict[str, MonthResult] = {}
        for file in sorted(scan_inbox(config.inbox, config.symbol), key=lambda f: f.year_month):
            out[file.year_month] = process(spark, config, ledger, file, force)
            if out[file.year_month].status == "paused_low_disk":
                break
        for r in finish(spark, config, ledger):
            out[r.year_month] = r if r.status != "done" or r.year_month not in out else out[r.year_month]
        return [out[m] for m in sorted(out)]
    finally:
        ledger.close()


def delete_source(config: Config, ledger: Ledger, month: str) -> bool:
    """Deletes a month's archive once its ticks are done and verified; whether a file was there."""
    row = ledger.month(config.symbol, month)
    if not row or row["status"] != "done" or row["verification_status"] != "verified":
        raise VerificationFailedError(f"{month} is not done and verified; its source stays")
    path = Path(row["source_path"])
    there = path.exists()
    path.unlink(missing_ok=True)
    ledger.update(config.symbol, month, source_deleted_at=time.time())
    return there
