import pytest

from tests.conftest import SF, rows_of
from tickforge.llm.oracles import ORACLES
from tickforge.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, duck):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows_of(ours) == rows_of(theirs)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
