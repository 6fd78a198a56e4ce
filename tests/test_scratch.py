import pytest

from workload.scratch import run_folder


class Session:
    """Only what `run_folder` asks of a session on a cluster."""

    def __init__(self, settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": "spark://host:7077"})


def test_folders_are_new_and_under_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = run_folder(spark), run_folder(spark)
    assert first != second
    assert first.startswith(f"{shared}/") and second.startswith(f"{shared}/")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="every executor"):
        run_folder(Session({}))
    assert run_folder(Session({"spark.checkpoint.dir": "hdfs:///x/"})).startswith("hdfs:///x/tick")
