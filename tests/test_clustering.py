from glob import glob

import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tellerbook.sources.clustering import Cuts, boundaries, write_clustered, z_key


@pytest.fixture
def gold(spark):
    """Accounts and types that say nothing about each other."""
    return spark.range(40_000).select(
        F.concat(F.lpad((F.xxhash64("id") % 900 + 900).cast("string"), 4, "0"), F.lit("-x")).alias("account_id"),
        F.concat(F.lit("TYPE_"), F.lpad((F.hash("id") % 40 + 40).cast("string"), 2, "0")).alias("transaction_type"),
        F.col("id").alias("qty"),
        (F.col("id") % 3).alias("day"),
    )


def matching(path, column, value):
    """Files whose smallest and largest value of the column let the value in, and all files."""
    files = glob(f"{path}/**/*.parquet", recursive=True)
    n = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        n += min(s.min for s in stats) <= value <= max(s.max for s in stats)
    return n, len(files)


def test_filters_on_either_column_skip_files(spark, gold, folder):
    write_clustered(gold, f"{folder}/z", ["account_id", "transaction_type"], files=32)
    gold.repartitionByRange(32, "transaction_type").write.parquet(f"{folder}/sorted")
    wanted = {"account_id": [f"{i:04d}-x" for i in range(100, 1800, 100)], "transaction_type": [f"TYPE_{i:02d}" for i in range(5, 80, 5)]}
    for column, values in wanted.items():
        found = [matching(f"{folder}/z", column, v) for v in values]
        share = sum(n for n, _ in found) / sum(total for _, total in found)
        assert found[0][1] >= 16 and share < 0.36, (found[0][1], share)
    # Sorted by one column, a filter on the other reads all.
    n, total = matching(f"{folder}/sorted", "account_id", "0900-x")
    assert n == total


def test_the_rows_are_the_same(spark, gold, folder):
    odd = gold.limit(50).withColumn("account_id", F.lit(None).cast("string")).union(gold.limit(500))
    write_clustered(odd, f"{folder}/z", ["account_id", "qty"], files=4, partition="day")
    back = spark.read.parquet(f"{folder}/z").select(odd.columns)
    assert rows(back.withColumn("day", F.col("day").cast("long"))) == rows(odd)
    write_clustered(odd.limit(0), f"{folder}/empty", ["account_id", "qty"], files=4)
    assert spark.read.schema(odd.schema).parquet(f"{folder}/empty").count() == 0


def test_the_key_alternates_the_bits(spark):
    grid = spark.range(4096).selectExpr("id div 64 AS a", "id % 64 AS b")
    cuts = [Cuts(c, [float(i) for i in range(1, 64)], None) for c in "ab"]
    keys = {(r.a, r.b): r.z for r in grid.select("a", "b", z_key(cuts).alias("z")).collect()}
    assert sorted(keys.values()) == list(range(4096))
    assert (keys[0, 0], keys[0, 1], keys[1, 0], keys[1, 1], keys[2, 0]) == (0, 1, 2, 3, 8)


def test_boundaries_are_quantiles(spark, gold):
    qty, account, kind = boundaries(gold, ["qty", "account_id", "transaction_type"])
    assert len(qty.bounds) == 63 and abs(qty.bounds[31] - 20_000) < 200
    assert account.common == 0 and len(account.bounds) > 50
    assert kind.common == len("TYPE_") and len(kind.bounds) > 50


def test_few_values_are_spread_over_all_ranges(spark):
    rows_ = spark.range(100).selectExpr("CASE WHEN id % 2 = 0 THEN 'PIX' WHEN id = 1 THEN NULL ELSE 'TED' END AS t")
    (cuts,) = boundaries(rows_, ["t"])
    numbers = {r.t: r.n for r in rows_.select("t", cuts.number().alias("n")).collect()}
    assert numbers[None] == 0 and numbers["PIX"] < numbers["TED"] and numbers["TED"] >= 32
