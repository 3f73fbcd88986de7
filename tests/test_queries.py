"""Each graded query against its SQL on the smallest tables."""

import pytest

from tests.conftest import SF, rows_of
from tickforge.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, duck):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_whole_table_is_validated(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert QUERIES["validation_report_whole"](spark, SF).first().rows_seen == events.count() + events.where("event_id % 50 < 2").count()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
