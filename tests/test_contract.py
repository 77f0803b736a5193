"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest
from check import compare

import __spark_entry__ as contract
from tellerbook import session

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(contract._QUERIES))
def test_query_equals_its_twin(spark, name):
    assert compare(spark, FOLDER, name).startswith("ok")


def test_every_query_has_a_twin():
    assert set(contract._QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


class Cluster:
    """Stands for a session; only its settings are asked."""

    def __init__(self, **settings):
        self.conf = {"spark.master": "yarn"} | settings


def test_working_folder_is_the_shared_one():
    cluster = Cluster(**{"spark.checkpoint.dir": "hdfs://shared/jobs/"})
    one, two = (session.working_folder(cluster, "t") for _ in range(2))
    assert one.startswith("hdfs://shared/jobs/tellerbook-t-") and one != two


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.working_folder(Cluster(), "t")
