"""Consistency with earlier runs: amounts against the sketches of runs before.

A run's amounts are kept as a quantile sketch per transaction type, of a few KB whatever
the number of rows. Two sketches are compared by the greatest difference of ranks: how
far apart the shares of amounts up to any value are. Beyond a limit a check of level
``error`` fails, which closes the gate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.sources.tables import complete

TYPE = "transaction_type"
#: Values a level of the sketch holds; the rank error is about 1.3 % at 200 and 0.3 % at 1000.
SIZE = 1000
#: Steps of the ranks at whose values two sketches are compared.
STEPS = 256
#: The Kolmogorov-Smirnov statistic that equal distributions exceed once in a hundred times.
CHANCE = 1.63


def amount_sketches(silver: DataFrame) -> DataFrame:
    """(type, n, sketch) of the finite amounts of each type; made in the tasks before the exchange."""
    amount = F.col("amount_usd")
    finite = ~F.isnan(amount) & (F.abs(amount) < float("inf"))
    return silver.where(finite).groupBy(TYPE).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double("amount_usd", F.lit(SIZE)).alias("sketch")
    )


def write_run(sketches: DataFrame, root: str, run: int) -> None:
    """Keep a run's sketches; a repeated run replaces its own."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/run={int(run)}")


def read_runs(spark: SparkSession, root: str, last: int | None = None) -> DataFrame:
    """The sketches of the complete runs, or the ``last`` of them, united per type."""
    numbers = complete(spark, root, "run=")
    kept = numbers if last is None else numbers[-last:]
    schema = f"{TYPE} string, n long, sketch binary"
    if not kept:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{root}/run={n}" for n in kept])
    return rows.groupBy(TYPE).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def rank_distance(one: Column | str, two: Column | str) -> Column:
    """The greatest difference of the two sketches' ranks, at quantiles of both; 0 to 1.

    A value's rank is the share of a sketch's quantiles up to it, right to 1 / STEPS.
    """
    shares = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    quantiles = [F.kll_sketch_get_quantile_double(s, shares) for s in (one, two)]

    def apart(own: Column) -> Column:
        def ranks(v: Column) -> list[Column]:
            return [F.size(F.filter(own[k], lambda q: q <= v)) for k in ("a", "b")]

        def differ(v: Column) -> Column:
            low, high = ranks(v)
            return F.abs(low - high) / (STEPS + 1)

        return F.array_max(F.transform(F.concat(own["a"], own["b"]), differ))

    both = F.array(F.struct(quantiles[0].alias("a"), quantiles[1].alias("b")))
    return F.element_at(F.transform(both, apart), 1)


def compare_runs(now: DataFrame, before: DataFrame) -> DataFrame:
    """(type, n, n_before, distance); a type of only one side has distance 1.0."""
    old = before.select(F.col(TYPE).alias("_type"), F.col("n").alias("n_before"), F.col("sketch").alias("_old"))
    joined = now.join(old, F.col(TYPE).eqNullSafe(F.col("_type")), "full_outer")
    both = F.col("sketch").isNotNull() & F.col("_old").isNotNull()
    return joined.select(
        F.coalesce(TYPE, "_type").alias(TYPE),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("n_before", F.lit(0)).alias("n_before"),
        F.when(both, rank_distance("sketch", "_old")).otherwise(F.lit(1.0)).alias("distance"),
    )


def check_drift(now: DataFrame, before: DataFrame, limit: float = 0.1, level: str = "error") -> DataFrame:
    """One (check, level, failing_rows) line: the rows of types whose amounts have moved.

    A distance may exceed ``limit`` by what chance alone allows two samples of these sizes
    (once in a hundred times), so types of few rows are judged mildly. A first run,
    which has nothing before it, passes; so do types that are new or gone.
    """
    told = (F.col("n") > 0) & (F.col("n_before") > 0)
    chance = CHANCE * F.sqrt(1 / F.col("n") + 1 / F.col("n_before"))
    moved = F.when(told & (F.col("distance") > limit + chance), F.col("n")).otherwise(0)
    compared = compare_runs(now, before).where(told)
    return compared.agg(F.coalesce(F.sum(moved), F.lit(0)).alias("failing_rows")).select(
        F.lit("drift:amount_usd").alias("check"), F.lit(level).alias("level"), "failing_rows"
    )
