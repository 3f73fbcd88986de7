"""Archives, ledger and the ingestion's life."""

import hashlib
import io
import logging
import zipfile

from pathlib import Path

import pytest

from tickforge import config as C
from tickforge.cli import discover, main, status
from tickforge.errors import CorruptedArchiveError, VerificationFailedError, WrongMarketError
from tickforge.plans import ingest as I
from tickforge.plans import warehouse as W
from tickforge.plans.ledger import Ledger, following, missing, next_required
from tickforge.plans.report import report_text
from tickforge.sources import layout as L
from tickforge.sources.archives import read_archives

HEADER = "id,price,qty,quote_qty,time,is_buyer_maker\n"


def lines(n=40, start=1, t=1_704_067_200_000):
    return "".join(f"{start + i},{100 + i % 7}.5,{1 + i % 3},{(100.5 + i % 7) * (1 + i % 3)},{t + i * 61_000},{'true' if i % 3 else 'false'}\n" for i in range(n))


def put(folder, name, text):
    p = folder / name
    if name.endswith(".zip"):
        with zipfile.ZipFile(p, "w") as z:
            z.writestr(name.replace(".zip", ".csv"), text)
    else:
        p.write_text(text)
    return p


@pytest.fixture
def config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text(f"symbol: BTC\nstart_month: '2024-01'\ninbox: {tmp_path / 'in'}\nwarehouse: {tmp_path / 'out'}\nmin_free_disk_gb: 0.001\nrow_group_rows: 20\nintervals: [1min, 1h, 1d]\nfeatures: {{orderflow_intervals: [1min, 1h]}}\n")
    return C.load(path)


def test_layout(tmp_path):
    assert L.verify(put(tmp_path, "A-trades-2024-01.csv", HEADER + lines())).status == "ok"
    assert L.verify(put(tmp_path, "A-trades-2024-02.zip", lines())).status == "ok"
    assert L.verify(put(tmp_path, "A-trades-2024-03.csv", "1,2\n")).status == "empty"
    assert L.verify(put(tmp_path, "A-trades-2024-04.csv", lines().replace("\n", ",true\n"))).status == "wrong_market"
    for n in (5, 8):
        assert L.verify(put(tmp_path, "A-trades-2024-05.csv", (",".join("12345678"[:n]) + "\n") * 20)).status == "corrupted"
    broken = tmp_path / "A-trades-2024-06.zip"
    broken.write_bytes(b"PK" + b"x" * 100)
    assert L.verify(broken).status == "corrupted"
    with zipfile.ZipFile(tmp_path / "A-trades-2024-07.zip", "w") as z:
        z.writestr("a.csv", lines())
        z.writestr("b.csv", lines())
    assert L.verify(tmp_path / "A-trades-2024-07.zip").status == "unsupported_layout"
    tiny = tmp_path / "A-trades-2024-08.zip"
    tiny.write_bytes(b"PK")
    assert L.verify(tiny).status == "corrupted"
    assert L.verify(put(tmp_path, "A-trades-2024-09.zip", "1,2\n")).status == "empty"
    # a flipped byte inside the packed CSV
    raw = bytearray(put(tmp_path, "A-trades-2024-10.zip", HEADER + lines()).read_bytes())
    raw[len(raw) // 2] ^= 0xFF
    (tmp_path / "A-trades-2024-10.zip").write_bytes(raw)
    assert L.verify(tmp_path / "A-trades-2024-10.zip").status == "corrupted"
    (tmp_path / "notes.csv").write_text("x")
    assert [f.year_month for f in L.scan_inbox(tmp_path, "A")] == [f"2024-{k:02d}" for k in range(1, 11)]
    assert [p.name for p in L.unrecognized(tmp_path)] == ["notes.csv"]
    head = lambda text: L.Head.of(io.BytesIO(text))
    assert head(b"id,price\n-5,1,1,1,1,true\n") == (True, 6) and head(b"-5,1,1,1,1,true") == (False, 6) and head(b"") == (True, 0)
    with pytest.raises(WrongMarketError):
        head(b"1,2,3,4,5,true,true").checked("x")
    with pytest.raises(CorruptedArchiveError):
        head(b"\n").checked("x")


def test_sidecar(tmp_path):
    p = put(tmp_path, "A-trades-2024-01.csv", lines())
    digest = hashlib.sha256(p.read_bytes()).hexdigest()
    side = tmp_path / f"{p.name}.CHECKSUM"
    side.write_text(f"{digest.upper()}  {p.name}\n")
    assert L.verify(p).checksum_matched is True
    side.write_text("00  x\n")
    assert L.verify(p).status == "corrupted"


def test_source_order_and_units(spark, tmp_path):
    a = put(tmp_path, "A-trades-2024-01.zip", HEADER + lines(5))
    b = put(tmp_path, "A-trades-2024-02.csv", lines(5, t=1_704_067_200_000_000))
    t = read_archives(spark, [str(a), str(b)], "A").orderBy("source_file", "source_row").collect()
    assert [r.trade_id for r in t] == [1, 2, 3, 4, 5] * 2 and {r.trade_time_ns for r in t if r.trade_id == 1} == {1_704_067_200_000_000_000}
    with pytest.raises(Exception, match="trade_id|CSV|conversion|Corrupt"):
        read_archives(spark, [str(put(tmp_path, "A-trades-2024-03.csv", lines(3) + "x,1,1,1,1,true\n"))], "A").count()


def test_ledger(tmp_path):
    led = Ledger(tmp_path / "l.sqlite")
    with pytest.raises(KeyError):
        led.update("A", "2024-01", status="done")
    for m in ("2023-12", "2024-02"):
        led.begin("A", m, "p", "zip")
        led.update("A", m, status="done", rows_written=5)
    assert following("2023-12") == "2024-01" and next_required(led, "A", "2023-12") == "2024-03" and missing(led, "A", "2023-12") == ["2024-01"]
    assert next_required(led, "B", "2020-05") == "2020-05" and led.totals("A")["rows_written"] == 10


def test_whole_life(spark, config):
    put(config.inbox, "BTC-trades-2024-01.zip", HEADER + lines(60) + "61,0,1,0,1704067300000,true\n")
    put(config.inbox, "BTC-trades-2024-02.csv", lines(30, 100, 1_706_745_600_000))
    put(config.inbox, "BTC-trades-2024-03.csv", lines(30).replace("\n", ",true\n"))
    assert [(r.year_month, r.status) for r in I.run(spark, config)] == [("2024-01", "done"), ("2024-02", "done"), ("2024-03", "failed")]
    led = Ledger(config.ledger)
    row = led.month("BTC", "2024-01")
    assert (row["rows_seen"], row["rows_rejected"], row["rows_written"], row["checkpoint"]) == (61, 1, 60, "reported")
    assert len(I.done_paths(config, led)) == 2
    assert W.current(spark, config.warehouse / "bars" / "1d").count() == 2
    names = {p.name for p in (config.warehouse / "features").iterdir()}
    assert {"atr_1h", "footprint", "orderflow_1min", "session_profile_summary", "developing_poc"} <= names
    assert W.current(spark, config.warehouse / "features" / "footprint").count() > 0
    assert list(config.reports.glob("BTC_2024-01_*.md")) and "The source may: be deleted" in report_text(config, led, "2024-01")
    assert any("reported" in x for x in status(config)) and any("wrong_market" in x for x in discover(config))
    import pyarrow.parquet as pq

    part = next(p for p in Path(row["ticks_path"]).glob("*.parquet"))
    assert pq.ParquetFile(part).metadata.row_group(0).num_rows <= 20
    assert "verified" in report_text(config, led, "2024-01") and "footprint" in report_text(config, led, "2024-01")
    stored = W.current(spark, config.warehouse / "features" / "orderflow_1min").toPandas()
    assert stored["bar_time"].is_monotonic_increasing
    # again: nothing to do
    assert [r.detail for r in I.run(spark, config)][:2] == ["already reported"] * 2
    with pytest.raises(VerificationFailedError):
        I.delete_source(config, led, "2024-03")
    assert I.delete_source(config, led, "2024-01") and not (config.inbox / "BTC-trades-2024-01.zip").exists()
    # a stop before the report, without the source: resumed
    led.update("BTC", "2024-01", checkpoint="features_generated")
    assert I.finish(spark, config, led)[0].detail == "resumed" and led.month("BTC", "2024-01")["checkpoint"] == "reported"
    # damaged ticks are found and taken from the source again
    led.update("BTC", "2024-02", checkpoint="ticks_written", verification_status=None, rows_written=7)
    assert [r.status for r in I.run(spark, config) if r.year_month == "2024-02"] == ["failed"]
    assert [r.status for r in I.run(spark, config) if r.year_month == "2024-02"] == ["done"]


def test_config_and_cli(tmp_path, config, capsys):
    assert main(["--config", str(tmp_path / "c.yaml"), "--status"]) == 0 and "next: 2024-01" in capsys.readouterr().out
    (tmp_path / "bad.yaml").write_text("symbol: A\n")
    with pytest.raises(ValueError, match="start_month"):
        C.load(tmp_path / "bad.yaml")


def test_stream(spark, tmp_path):
    from tickforge.operators.bars import bars
    from tickforge.schemas import TICKS
    from tickforge.streaming.bars import streaming_bars

    rows = [("A", i, 100.0 + i % 5, 1.0, 100.0 + i % 5, 1_704_067_200_000_000_000 + i * 20_000_000_000, i % 2 == 0) for i in range(30)]
    t = spark.createDataFrame(rows, TICKS)
    t.write.parquet(str(tmp_path / "t"))
    q = streaming_bars(spark.readStream.schema(TICKS).parquet(str(tmp_path / "t"))).writeStream.format("memory").queryName("bars_stream").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("bars_stream").collect())) == sorted(map(tuple, bars(t, "1min").collect()))


def test_disk_guard_stops_a_running_write(spark, tmp_path, monkeypatch):
    from tickforge.errors import DiskSpaceGuardError

    looks = iter([None, None])

    def low(folder, least):
        if next(looks, "low"):
            raise DiskSpaceGuardError("low")

    monkeypatch.setattr(W, "check_disk", low)
    slow = spark.range(4, numPartitions=4).selectExpr("id", "reflect('java.lang.Thread', 'sleep', 20000L)")
    with pytest.raises(DiskSpaceGuardError), W.disk_guard(spark, tmp_path, 1.0, every_s=0.5):
        slow.write.parquet(str(tmp_path / "x"))


def test_missing_ticks_are_named(config, caplog):
    led = Ledger(config.ledger)
    led.begin("BTC", "2024-01", "p", "zip")
    led.update("BTC", "2024-01", status="done", ticks_path=str(config.ticks / "gone"))
    with caplog.at_level(logging.WARNING, "tickforge"):
        assert I.done_paths(config, led) == []
    assert "2024-01" in caplog.text
