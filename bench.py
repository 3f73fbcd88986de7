"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tickforge import queries as library  # noqa: E402
from tickforge.session import pin  # noqa: E402

HEADLINE = ("bars_1s", "bars_1min", "bars_1h", "bars_1mo", "bars_lineitem_1d", "bars_cascade_1d", "orderflow_1h", "session_vwap_1min", "atr_1h", "realized_vol_1h", "large_trades", "stacked_imbalances", "delta_divergence", "absorption_candidates", "iceberg_candidates", "footprint_1min", "session_volume_profile", "session_profile_summary", "developing_poc", "validation_report")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus if cpus != "*" else "8").config("spark.driver.memory", "8g")
    spark = pin(builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    library.flagship(spark, folder).count()  # starts the session's threads and compiler
    took = {}
    for name in HEADLINE:
        began = time.time()
        library.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total query time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
