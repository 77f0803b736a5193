
import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerbook.llm.groups import each_group
from tellerbook.llm.store import TASKS_A_CORE, few_tasks, stored


@pytest.fixture
def most(spark):
    return TASKS_A_CORE * spark.sparkContext.defaultParallelism


def spread(spark, n, partitions):
    """Rows dealt by key over a fixed number of partitions, most of them small."""
    rows = spark.range(n).select("id", (F.col("id") % 97).alias("g"))
    return rows.repartition(partitions, "g")


def test_a_stored_table_has_few_files_and_all_rows(spark, most):
    for partitions in (3, most + 13, 10 * most):
        table = stored(spread(spark, 5000, partitions), "few-files")
        assert len(table.inputFiles()) <= min(partitions, most)
        assert sorted(r.id for r in table.collect()) == list(range(5000))


def test_few_tasks_keep_partitions_whole_and_in_order(spark, most):
    rows = spread(spark, 5000, 4 * most).withColumn("before", F.spark_partition_id())
    rows = rows.sortWithinPartitions("g", "id")
    parts = few_tasks(rows).withColumn("after", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    assert len({r.after for r in parts}) <= most
    assert len({(r.before, r.after) for r in parts}) == len({r.before for r in parts})
    last = {}
    for r in sorted(parts, key=lambda r: r["at"]):
        assert last.get(r.before, (-1, -1)) < (r.g, r.id)
        last[r.before] = (r.g, r.id)
    assert len(parts) == 5000


def test_groups_stay_whole_with_many_partitions(spark, most):
    """Each group once, in order, whether a task has one partition or several; few tasks start Python."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(4 * most))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:

        def seen(rows):
            ids = rows.column("id").to_numpy()
            assert (np.diff(ids) > 0).all()
            yield {"g": np.array([rows.column("g")[0].as_py()]), "n": np.array([len(ids)]), "total": np.array([ids.sum()])}

        found = each_group(spark.range(5000).select("id", (F.col("id") % 97).alias("g")), "g", seen, "g long, n long, total long", "id")
        assert found.rdd.getNumPartitions() <= most
        got = {r.g: (r.n, r.total) for r in found.collect()}
        assert len(got) == found.count() == 97
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    assert got == {g: (len(range(g, 5000, 97)), sum(range(g, 5000, 97))) for g in range(97)}


def test_tasks_grow_with_the_shuffle_partitions(spark, most):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(12 * most))
    try:
        assert few_tasks(spark.range(0, 5000, 1, 12 * most)).rdd.getNumPartitions() == 3 * most
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
