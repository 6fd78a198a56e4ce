import __spark_entry__ as entry
import check
import pytest
from helpers import plan

from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert check.differences(spark, connection, SF_DIR, name) is None


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


# The others return a stored result, so their plan is a scan.
STREAMED = ("stream_", "layered_", "chained_", "schema_", "progress")
BATCH = [name for name in QUERIES if not name.startswith(STREAMED)]


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans_stay_distributed_and_on_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for unwanted in ("SinglePartition", "Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


@pytest.mark.parametrize(
    ("one", "other"),
    [
        ("clean_dedup_first", "clean_filter_first"),
        ("stream_clean", "stream_clean_filter_first"),
        ("stream_clean_bounded", "stream_clean_filter_first"),
        ("stream_clean_bounded", "stream_clean"),
    ],
)
def test_the_feeds_tell_features_apart(one, other):
    connection = check.oracle_connection("/root/testdata/sf0.01")
    rows = [set(map(str, connection.execute(ORACLES[q]).fetchall())) for q in (one, other)]
    assert rows[0] != rows[1]
