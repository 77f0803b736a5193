"""The jobs: bronze to silver, quality gate, gold; backfill and refresh."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.operators.drift import amount_sketches, check_drift, read_runs, write_run
from tellerbook.operators.gold import gold_account_summary
from tellerbook.operators.quality import (
    RowCheck,
    check_unique,
    gate,
    observe_row_checks,
    silver_checks,
)
from tellerbook.operators.silver import build_silver
from tellerbook.operators.synth import synthesize_transactions
from tellerbook.plans.deltas import fold_changes, has_parts, replace_parts, write_parts
from tellerbook.plans.index import find, update_index, write_index
from tellerbook.plans.stored import (
    TIME,
    dated,
    dates_of,
    read_gold,
    read_silver,
    replace_dates,
)
from tellerbook.plans.stored import on_dates as _on_dates
from tellerbook.schemas import DATE, HIGH_VALUE_THRESHOLD, KEY
from tellerbook.session import working_folder
from tellerbook.sources.bronze import read_bronze
from tellerbook.sources.events import write_events
from tellerbook.sources.tables import current_version, next_version, version_path, write_daily
from tellerbook.streaming.ingest import run_ingest

__all__ = ["backfill", "read_gold", "read_silver", "refresh_gold_dates", "run_pipeline", "write_gold", "write_silver"]

def write_silver(
    silver: DataFrame, root: str, checks: Sequence[RowCheck], version: int | None = None
) -> list[tuple[str, str, int]]:
    """Write a whole new version by date and count failing rows on the way."""
    number = version or next_version(silver.sparkSession, root)
    together = dated(silver).hint("rebalance", DATE)
    observed, seen = observe_row_checks(together, checks, "silver_checks")
    observed.write.partitionBy(DATE).parquet(version_path(root, number))
    return [(c.name, c.level, seen.get[c.name]) for c in checks]


def write_gold(gold: DataFrame, root: str, version: int | None = None) -> None:
    """Write a whole new version, by date and ordered by type within a file.

    Readers move to it once it is complete; a failed run leaves the old one.
    """
    number = version or next_version(gold.sparkSession, root)
    write_daily(gold, version_path(root, number), DATE, cluster="transaction_type")


def run_pipeline(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    gold_root: str,
    threshold: float = HIGH_VALUE_THRESHOLD,
    checks: Sequence[RowCheck] | None = None,
    buckets: int | None = None,
    runs_root: str | None = None,
) -> list[tuple[str, str, int]]:
    """Silver, then its checks, then gold; gold is untouched if a check fails.

    Silver is de-duplicated once and stored, so the checks and gold do not
    repeat that shuffle. Silver and the gold made from it carry the same version
    number. With ``buckets`` the ids are indexed in so many folders and gold is kept in
    parts too, as refreshes by date or by signed deltas use. With ``runs_root`` the
    amounts are held against those of the run before that passed. Returns one (check,
    level, failing rows) per check.
    """
    checks = silver_checks() if checks is None else checks
    silver = build_silver(read_bronze(spark, bronze_root), threshold)
    version = next_version(spark, silver_root, gold_root)
    results = write_silver(silver, silver_root, checks, version)
    stored = read_silver(spark, silver_root, version)
    # One line.
    results += [tuple(row) for row in check_unique(stored, KEY).collect()]
    if runs_root:
        sketches = amount_sketches(stored)
        results += [tuple(row) for row in check_drift(sketches, read_runs(spark, runs_root, last=1)).collect()]
    gate(results)
    if runs_root:
        write_run(sketches, runs_root, version)
    if buckets:
        write_index(stored, silver_root, version, buckets)
        write_parts(stored, gold_root, version)
    write_gold(gold_account_summary(stored, unique_ids=True), gold_root, version)
    return results


def backfill(
    spark: SparkSession,
    landing: str,
    bronze_root: str,
    checkpoint: str,
    start: str = "2026-07-07",
    days: int = 6,
    per_day: int = 500,
    seed: int = 0,
) -> None:
    """Publish transactions for a gap in the past and ingest them."""
    missed = synthesize_transactions(spark, days * per_day, start, days, seed)
    write_events(missed, landing)
    run_ingest(spark, landing, bronze_root, checkpoint)


def refresh_gold_dates(
    spark: SparkSession,
    fresh: DataFrame,
    silver_root: str,
    gold_root: str,
    threshold: float = HIGH_VALUE_THRESHOLD,
    checks: Sequence[RowCheck] | None = None,
) -> list[date | None]:
    """Bring stored silver and gold up to date with new bronze rows.

    Equals a full rebuild, but reads whole rows only of the dates concerned:
    those the new versions fall on and those their earlier versions leave.
    Where these lie is looked up in the index of stored silver, if it has one, else
    stored silver is searched by id over two narrow columns. Ids are unique on
    both sides of every join. Returns the dates rewritten. Nothing is replaced if
    a check fails on the rows that would be written.

    The order is: stage, gold, silver, index. Until silver is replaced, running the
    same rows again finds the same work, so an interrupted run is repeated.
    """
    version = current_version(spark, gold_root)
    silver_path, gold_path = (version_path(r, version) for r in (silver_root, gold_root))
    work = working_folder(spark, "refresh")
    fold_changes(spark, silver_root, gold_root)
    stored = read_silver(spark, silver_root, version)

    dated(build_silver(fresh, threshold)).write.parquet(f"{work}/fresh")
    fresh = spark.read.schema(stored.schema).parquet(f"{work}/fresh")
    ids = fresh.select(KEY)

    # Where earlier versions of these ids lie, then those versions themselves.
    earlier_dates = dates_of(find(spark, stored, silver_root, version, ids))
    earlier = stored.where(_on_dates(earlier_dates)).join(ids, KEY, "left_semi")
    versions = earlier.withColumn("_stored", F.lit(True)).unionByName(
        fresh.withColumn("_stored", F.lit(False))
    )

    # An id changes if its latest version is new, or if an interrupted run left
    # two rows of it behind. An id has one stored row, or a few after such a run.
    row = F.struct(TIME, *[c for c in stored.columns if c not in (KEY, TIME)])
    before = F.when(F.col("_stored"), row)
    judged = versions.groupBy(KEY).agg(
        F.max(row).alias("_latest"),
        F.max(before).alias("_before"),
        F.collect_list(F.when(F.col("_stored"), F.struct(DATE))).alias("_left"),
    )
    changed = judged.where(
        ~F.col("_latest").eqNullSafe(F.col("_before")) | (F.size("_left") > 1)
    ).select(KEY, "_latest.*", "_left")
    changed.write.parquet(f"{work}/changed")
    changed = spark.read.schema(changed.schema).parquet(f"{work}/changed")
    winners = changed.select(*stored.columns)

    left = changed.select(F.inline("_left"))
    dates = dates_of(left.union(winners.select(DATE)))
    if not dates:
        return []

    # The rows to be written are counted and checked by the job that stages them.
    checks = silver_checks() if checks is None else checks
    kept = stored.where(_on_dates(dates)).join(winners.select(KEY), KEY, "left_anti")
    staging = kept.unionByName(winners).hint("rebalance", DATE)
    observed, seen = observe_row_checks(staging, checks, "refresh_checks")
    observed.write.partitionBy(DATE).parquet(f"{work}/staged")
    staged = spark.read.schema(stored.schema).parquet(f"{work}/staged")

    # The gate stands before anything is replaced. Ids are unique by construction.
    gate((c.name, c.level, seen.get[c.name]) for c in checks)

    filled = set(dates_of(staged))
    emptied = [d for d in dates if d not in filled]
    if has_parts(spark, gold_root, version):
        replace_parts(spark, staged, silver_root, gold_root, version, emptied)
    replace_dates(gold_account_summary(staged, unique_ids=True), gold_path, emptied)
    replace_dates(staged, silver_path, emptied)
    update_index(spark, silver_root, version, winners)
    return sorted(dates, key=lambda d: (d is None, d))
