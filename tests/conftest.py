import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tickforge.session import pin

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield pin(s)
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows_of(frame) -> list:
    """Rows of a pandas frame, columns by name, comparable across engines."""
    import math

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) == "NaT":
            return "null"
        return repr(float(v)) if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False))
