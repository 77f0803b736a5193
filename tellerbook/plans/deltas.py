"""Gold by signed deltas: a changed id takes its old row out of gold and puts the new one in.

A refresh reads the old rows of the ids that arrived, and nothing else of silver's
content, and of gold only the days of those rows. What changed is committed first, as
signed rows; gold is then brought up to it, day by day, and each day knows the last
change it has. So a run that stops anywhere is finished by the next one, and no
change counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.operators.gold import add_parts, gold_from_parts, gold_parts
from tellerbook.operators.quality import RowCheck, gate, run_row_checks, silver_checks
from tellerbook.operators.silver import build_silver
from tellerbook.plans.index import find, update_index
from tellerbook.plans.stored import (
    PARTS,
    SEQ,
    SIGN,
    STORED,
    THROUGH,
    TIME,
    change_numbers,
    changes_path,
    dated,
    dates_of,
    newest_changes,
    on_dates,
    parts_path,
    read_base,
    read_changes,
    replace_dates,
)
from tellerbook.schemas import DATE, GOLD_KEYS, GOLD_PARTS, HIGH_VALUE_THRESHOLD, KEY
from tellerbook.session import working_folder
from tellerbook.sources.tables import (
    complete,
    current_version,
    exists,
    make_folder,
    numbered,
    remove_folder,
    version_path,
    write_daily,
)

_PART_NAMES = [f.name for f in GOLD_PARTS]


def _applied_path(gold_root: str, version: int) -> str:
    return f"{gold_root}/applied/version={version}"


def has_parts(spark: SparkSession, gold_root: str, version: int) -> bool:
    return exists(spark, f"{parts_path(gold_root, version)}/_SUCCESS")


def _counted_in(silver: DataFrame) -> DataFrame:
    return gold_parts(silver.withColumn(SIGN, F.lit(1)))


def write_parts(silver: DataFrame, gold_root: str, version: int) -> None:
    """Gold in parts for a whole silver version without changes."""
    rows = _counted_in(silver).withColumn(THROUGH, F.lit(0).cast("long"))
    write_daily(rows, parts_path(gold_root, version), DATE, cluster="transaction_type")


def replace_parts(
    spark: SparkSession, silver: DataFrame, silver_root: str, gold_root: str, version: int, emptied: Sequence[date | None]
) -> None:
    """Parts of whole days from all their silver rows; the changes so far must be folded in."""
    last = max(complete(spark, _applied_path(gold_root, version), f"{SEQ}="), default=0)
    rows = _counted_in(silver).withColumn(THROUGH, F.lit(last).cast("long"))
    replace_dates(rows, parts_path(gold_root, version), emptied)


def _read_parts(spark: SparkSession, gold_root: str, version: int) -> DataFrame:
    return spark.read.schema(PARTS).parquet(parts_path(gold_root, version))


def stored_rows(spark: SparkSession, silver_root: str, version: int, ids: DataFrame) -> DataFrame:
    """The stored rows of these distinct ids: from the changes, else by way of the index."""
    base = read_base(spark, silver_root, version)
    newest = newest_changes(spark, silver_root, version)
    rest, since = ids, None
    if newest is not None:
        since = newest.join(ids, KEY, "left_semi")
        rest = ids.join(newest.select(KEY), KEY, "left_anti")
    places = find(spark, base, silver_root, version, rest)
    rows = base.where(on_dates(dates_of(places))).join(places.select(KEY), KEY, "left_semi")
    return rows if since is None else rows.unionByName(since)


def refresh_gold_deltas(
    spark: SparkSession,
    fresh: DataFrame,
    silver_root: str,
    gold_root: str,
    threshold: float = HIGH_VALUE_THRESHOLD,
    checks: Sequence[RowCheck] | None = None,
) -> int:
    """Bring stored silver and gold up to date with new bronze rows, by differences.

    Needs a version made with ``run_pipeline(..., buckets=...)``. Equals a full rebuild.
    Rows already in silver, or older than what is there, change nothing, so the same
    rows may come again. The gate closes before anything is committed. Returns the
    number of changed ids.
    """
    version = current_version(spark, gold_root)
    if not has_parts(spark, gold_root, version):
        raise ValueError("gold has no parts; run the pipeline with buckets first")
    apply_changes(spark, silver_root, gold_root)
    work = working_folder(spark, "delta")
    dated(build_silver(fresh, threshold)).write.parquet(f"{work}/fresh")
    fresh = spark.read.schema(STORED).parquet(f"{work}/fresh")

    before = stored_rows(spark, silver_root, version, fresh.select(KEY))
    row = F.struct(TIME, *[c for c in STORED.fieldNames() if c not in (KEY, TIME)])
    judged = (
        before.withColumn("_old", F.lit(True))
        .unionByName(fresh.withColumn("_old", F.lit(False)))
        .groupBy(KEY)
        .agg(F.max(row).alias("_new"), F.max(F.when(F.col("_old"), row)).alias("_old"))
    )
    changed = judged.where(~F.col("_new").eqNullSafe(F.col("_old")))
    versions = [F.struct(F.lit(n).alias(SIGN), F.col(c).alias("_row")) for n, c in ((-1, "_old"), (1, "_new"))]
    there = F.filter(F.array(*versions), lambda v: v["_row"].isNotNull())
    signed = changed.select(KEY, F.inline(there)).select(KEY, "_row.*", SIGN).select(*STORED.fieldNames(), SIGN)
    signed.write.parquet(f"{work}/signed")
    signed = spark.read.schema(signed.schema).parquet(f"{work}/signed")

    winners = signed.where(F.col(SIGN) == 1)
    n = winners.count()
    if not n:
        return 0
    checks = silver_checks() if checks is None else checks
    if checks:
        gate(tuple(r) for r in run_row_checks(winners, checks).collect())

    used = [m for path in (changes_path(silver_root, version), _applied_path(gold_root, version)) for m, _ in numbered(spark, path, f"{SEQ}=")]
    number = max(used, default=0) + 1
    # The commit: complete with its _SUCCESS file, or not there for any reader.
    signed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{changes_path(silver_root, version)}/{SEQ}={number}"
    )
    apply_changes(spark, silver_root, gold_root)
    return n


def apply_changes(spark: SparkSession, silver_root: str, gold_root: str) -> None:
    """Bring gold up to the committed changes; does nothing where none is open."""
    version = current_version(spark, gold_root)
    applied = set(complete(spark, _applied_path(gold_root, version), f"{SEQ}="))
    for number in change_numbers(spark, silver_root, version):
        if number not in applied:
            _apply(spark, silver_root, gold_root, version, number)
            make_folder(spark, f"{_applied_path(gold_root, version)}/{SEQ}={number}/_SUCCESS")


def _apply(spark: SparkSession, silver_root: str, gold_root: str, version: int, number: int) -> None:
    """Add one change to the parts of its days, then finish these days of gold."""
    work = working_folder(spark, "apply")
    gold_parts(read_changes(spark, silver_root, version, [number])).write.parquet(f"{work}/delta")
    delta = spark.read.schema(PARTS).parquet(f"{work}/delta")
    dates = dates_of(delta)

    # Days that an interrupted run has already brought up to this change stay as they are.
    held = _read_parts(spark, gold_root, version).where(on_dates(dates))
    done = dates_of(held.where(F.col(THROUGH) >= number))
    open_ = [d for d in dates if d not in set(done)]
    names = [*GOLD_KEYS, *_PART_NAMES]
    if open_:
        # Rows at 0 have served; the change's own rows stay, so the day keeps its number.
        old = held.where(on_dates(open_) & (F.col("qty") > 0))
        merged = add_parts(old.select(*names).unionByName(delta.where(on_dates(open_)).select(*names)))
        merged.withColumn(THROUGH, F.lit(number).cast("long")).write.parquet(f"{work}/merged")
        staged = spark.read.schema(PARTS).parquet(f"{work}/merged")
        replace_dates(staged, parts_path(gold_root, version), [])

    finished = gold_from_parts(_read_parts(spark, gold_root, version).where(on_dates(dates)))
    filled = set(dates_of(finished))
    replace_dates(finished, version_path(gold_root, version), [d for d in dates if d not in filled])


def fold_changes(spark: SparkSession, silver_root: str, gold_root: str) -> int:
    """Move the changes into the day folders of silver and into the index.

    Run it when reading silver gets slow, or as many changes pile up. Readers see the same
    rows before, during and after: until the changes are removed, their ids are read
    from them. An interrupted run is repeated. Returns the number of changes folded.
    """
    version = current_version(spark, gold_root)
    numbers = change_numbers(spark, silver_root, version)
    if not numbers:
        return 0
    apply_changes(spark, silver_root, gold_root)
    work = working_folder(spark, "fold")
    newest_changes(spark, silver_root, version).write.parquet(f"{work}/newest")
    newest = spark.read.schema(STORED).parquet(f"{work}/newest")
    base = read_base(spark, silver_root, version)
    ids = newest.select(KEY)
    dates = dates_of(find(spark, base, silver_root, version, ids).select(DATE).union(newest.select(DATE)))
    kept = base.where(on_dates(dates)).join(ids, KEY, "left_anti")
    kept.unionByName(newest).write.parquet(f"{work}/staged")
    staged = spark.read.schema(STORED).parquet(f"{work}/staged")
    filled = set(dates_of(staged))
    replace_dates(staged, version_path(silver_root, version), [d for d in dates if d not in filled])
    update_index(spark, silver_root, version, newest)
    for number in numbers:
        remove_folder(spark, f"{changes_path(silver_root, version)}/{SEQ}={number}")
    return len(numbers)
