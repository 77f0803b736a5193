import pytest
from helpers import bronze, event, event_rows
from pyspark.sql import functions as F

from tellerbook.operators import quality
from tellerbook.operators.silver import build_silver, flag_high_value, silver_cast


def counts(frame):
    return {r.check: (r.level, r.failing_rows) for r in frame.collect()}


def test_row_checks_in_one_pass(spark):
    items = [
        event("a"),
        event("b", transaction_type="CHEQUE", amount=-1),
        event("c", receiver_account="341-98765"),
        event("d", sender_account="12-1"),
    ]
    frame = quality.run_row_checks(
        build_silver(bronze(spark, items)), quality.silver_checks()
    )
    failing = {check for check, (_, n) in counts(frame).items() if n}
    assert failing == {
        "accepted_values:transaction_type",
        "expression:amount_not_negative",
        "expression:sender_is_not_receiver",
        "expression:sender_format",
    }
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_null_and_infinite_amounts(spark):
    items = [event(str(i), amount=a) for i, a in enumerate([float("nan"), float("inf"), None, 1.0])]
    silver = flag_high_value(silver_cast(event_rows(spark, items)))
    seen = counts(quality.run_row_checks(silver, quality.silver_checks()))
    assert seen["expression:amount_finite"] == ("error", 2)
    nulls = counts(quality.check_not_null(silver, ["amount_usd", "transaction_id"]))
    assert nulls["not_null:amount_usd"] == ("error", 1)
    assert nulls["not_null:transaction_id"] == ("error", 0)


def test_accepted_values_and_expression(spark):
    frame = spark.createDataFrame([("a", 1), ("b", -1), (None, None)], "k string, v int")
    seen = counts(quality.check_accepted_values(frame, "k", ["a"]))
    assert seen == {"accepted_values:k": ("warn", 1)}
    seen = counts(quality.check_expression(frame, "positive", F.col("v") > 0))
    assert seen == {"expression:positive": ("warn", 1)}


def test_unique_counts_repeated_keys(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert counts(quality.check_unique(frame, "k")) == {"unique:k": ("error", 1)}


def test_relationship_counts_orphan_rows(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "c int")
    parent = spark.createDataFrame([(2,), (2,), (None,)], "p int")
    seen = counts(quality.check_relationship(child, "c", parent, "p"))
    assert seen == {"relationship:c": ("error", 3)}
    none = counts(quality.check_relationship(child, "c", child, "c"))
    assert none == {"relationship:c": ("error", 0)}


def test_gate_only_closes_on_errors():
    quality.gate([("a", "error", 0), ("b", "warn", 9)])
    with pytest.raises(quality.QualityError, match="a \\(2\\)"):
        quality.gate([("a", "error", 2), ("b", "error", 0)])


def test_observed_checks_count_while_writing(spark, folder):
    frame = spark.range(10).withColumn("k", F.when(F.col("id") > 6, F.lit("x")))
    observed, seen = quality.observe_row_checks(frame, quality.not_null("k"), "t")
    observed.write.parquet(f"{folder}/out")
    assert seen.get["not_null:k"] == 7


def test_relationship_counts_before_it_shuffles(spark):
    """Without a broadcast, the join gets one row per child key."""
    child = spark.range(100).selectExpr("IF(id % 3 = 0, 7, id) AS c")
    parent = spark.range(50).selectExpr("id AS p")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = quality.check_relationship(child, "c", parent, "p")
        plan = frame._jdf.queryExecution().executedPlan().toString()
        below_join = plan[plan.index("SortMergeJoin") :]
        assert "partial_count" in below_join
        assert counts(frame)["relationship:c"][1] == child.where("c >= 50").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
