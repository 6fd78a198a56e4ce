import check
import pytest

from ticksmith.llm.queries import ORACLES, QUERIES

from .conftest import SF


def test_one_query_per_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert check.differences(spark, check.oracle_connection(SF), SF, name) is None
