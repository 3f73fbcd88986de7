"""Session settings that results depend on, and a session for local work."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Sessions are UTC days, whatever the machine's zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def pin(spark: SparkSession) -> SparkSession:
    for k, v in SETTINGS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local(cores: str = "*", partitions: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(partitions)).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    return pin(builder.config(map=SETTINGS).getOrCreate())
