"""The stored layers: silver by date with the changes made since, gold, and gold in parts.

``version=V`` holds the folders of each day. ``changes/version=V/seq=N`` under silver
holds what a delta refresh changed: the old row of an id with sign -1, the new one with
sign +1. ``parts/version=V`` under gold holds the same keys as gold in parts that add up,
each day with the number of the last change in it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from tellerbook.functions.columns import utc_date
from tellerbook.schemas import DATE, GOLD, GOLD_PARTS, KEY, SILVER
from tellerbook.sources.tables import complete, current_version, remove_folder, version_path, write_daily

TIME = "transaction_timestamp"
SEQ, SIGN, THROUGH = "seq", "sign", "through"
# A folder name Spark gives to the NULL partition; fixed value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
STORED = StructType([*SILVER, StructField(DATE, DateType())])
_CHANGES = StructType([*STORED, StructField(SIGN, IntegerType()), StructField(SEQ, LongType())])
PARTS = StructType(
    [*[f for f in GOLD if f.name in ("account_id", "transaction_type")], *GOLD_PARTS]
    + [StructField(THROUGH, LongType()), StructField(DATE, DateType())]
)


def dated(silver: DataFrame) -> DataFrame:
    return silver.withColumn(DATE, utc_date(F.col(TIME)))


def on_dates(dates: Sequence[date | None]) -> Column:
    known = [d for d in dates if d is not None]
    on = F.col(DATE).isin(known)
    return on | F.col(DATE).isNull() if len(known) < len(dates) else on


def dates_of(rows: DataFrame) -> list[date | None]:
    """Distinct dates: a list bounded by the calendar, not by the data."""
    return [row[0] for row in rows.select(DATE).distinct().collect()]


def replace_dates(
    rows: DataFrame, table: str, emptied: Sequence[date | None], cluster: str = "transaction_type"
) -> None:
    """Replace the date folders these rows fall in and remove the emptied ones."""
    for day in emptied:
        folder = f"{DATE}={day.isoformat() if day else _NULL_FOLDER}"
        remove_folder(rows.sparkSession, f"{table}/{folder}")
    write_daily(rows, table, DATE, cluster=cluster, replace="dynamic")


def changes_path(silver_root: str, version: int) -> str:
    return f"{silver_root}/changes/version={version}"


def parts_path(gold_root: str, version: int) -> str:
    return f"{gold_root}/parts/version={version}"


def change_numbers(spark: SparkSession, silver_root: str, version: int) -> list[int]:
    """The changes that are completely written, oldest first."""
    return complete(spark, changes_path(silver_root, version), f"{SEQ}=")


def read_changes(spark: SparkSession, silver_root: str, version: int, numbers: Sequence[int]) -> DataFrame:
    """The signed rows of these changes; only their folders are listed and read."""
    root = changes_path(silver_root, version)
    folders = [f"{root}/{SEQ}={n}" for n in numbers]
    return spark.read.schema(_CHANGES).option("basePath", root).parquet(*folders)


def newest_changes(spark: SparkSession, silver_root: str, version: int) -> DataFrame | None:
    """The newest row of each changed id; None without changes."""
    numbers = change_numbers(spark, silver_root, version)
    if not numbers:
        return None
    rows = read_changes(spark, silver_root, version, numbers).where(F.col(SIGN) == 1)
    rest = [c for c in STORED.fieldNames() if c != KEY]
    newest = rows.groupBy(KEY).agg(F.max_by(F.struct(*rest), F.col(SEQ)).alias("_row"))
    return newest.select(KEY, "_row.*").select(*STORED.fieldNames())


def read_base(spark: SparkSession, silver_root: str, version: int) -> DataFrame:
    """The stored day folders alone, without the changes made since."""
    return spark.read.schema(STORED).parquet(version_path(silver_root, version))


def read_silver(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The stored silver rows; a filter on the date reads only those folders.

    Ids changed since are read from the changes instead of the day folders.
    """
    number = current_version(spark, root) if version is None else version
    base = read_base(spark, root, number)
    newest = newest_changes(spark, root, number)
    if newest is None:
        return base
    return base.join(newest.select(KEY), KEY, "left_anti").unionByName(newest)


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    path = version_path(root, current_version(spark, root))
    return spark.read.schema(GOLD).parquet(path).select(*GOLD.fieldNames())
