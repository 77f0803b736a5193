"""Where each id of stored silver lies: (id, date), one folder per hash bucket of the id.

A lookup reads only the folders of its ids' buckets. A few ids touch a few folders; ids
of more buckets than there are touch all, over two narrow columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from tellerbook.schemas import DATE, KEY
from tellerbook.session import working_folder
from tellerbook.sources.tables import complete, write_daily

BUCKET = "bucket"
_PREFIX = "buckets="
_SCHEMA = StructType(
    [StructField(KEY, StringType()), StructField(DATE, DateType()), StructField(BUCKET, IntegerType())]
)


def _root(silver_root: str, version: int) -> str:
    return f"{silver_root}/index/version={version}"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")


def index_buckets(spark: SparkSession, silver_root: str, version: int) -> int | None:
    """The number of buckets of the version's index; None without an index."""
    found = complete(spark, _root(silver_root, version), _PREFIX)
    return found[-1] if found else None


def index_path(silver_root: str, version: int, buckets: int) -> str:
    return f"{_root(silver_root, version)}/{_PREFIX}{buckets}"


def write_index(silver: DataFrame, silver_root: str, version: int, buckets: int) -> None:
    """Index all rows of a silver version; rows need id and date."""
    rows = silver.select(KEY, DATE, _bucket(buckets).alias(BUCKET))
    write_daily(rows, index_path(silver_root, version, buckets), BUCKET, cluster=KEY)


def index_of(spark: SparkSession, silver_root: str, version: int, buckets: int, ids: DataFrame) -> DataFrame:
    """The index rows of the buckets that some id falls in, read by partition pruning."""
    # At most as many numbers as there are buckets.
    wanted = [row[0] for row in ids.select(_bucket(buckets)).distinct().collect()]
    path = index_path(silver_root, version, buckets)
    return spark.read.schema(_SCHEMA).parquet(path).where(F.col(BUCKET).isin(wanted))


def find(spark: SparkSession, stored: DataFrame, silver_root: str, version: int, ids: DataFrame) -> DataFrame:
    """(id, date) of those ids that stored silver has; ids must be distinct.

    Without an index all stored ids and dates are read.
    """
    buckets = index_buckets(spark, silver_root, version)
    held = stored if buckets is None else index_of(spark, silver_root, version, buckets, ids)
    return held.select(KEY, DATE).join(ids, KEY, "left_semi")


def update_index(spark: SparkSession, silver_root: str, version: int, moved: DataFrame) -> None:
    """Give each of these ids its new date; other buckets stay as they are.

    Comes after the silver folders are replaced: until then the old entries lead a
    repeated run to the rows it has to take away.
    """
    buckets = index_buckets(spark, silver_root, version)
    if buckets is None:
        return
    held = index_of(spark, silver_root, version, buckets, moved.select(KEY))
    kept = held.join(moved.select(KEY), KEY, "left_anti").select(KEY, DATE, BUCKET)
    fresh = moved.select(KEY, DATE, _bucket(buckets).alias(BUCKET))
    work = working_folder(spark, "index")
    kept.unionByName(fresh).write.parquet(work)
    staged = spark.read.schema(_SCHEMA).parquet(work)
    write_daily(staged, index_path(silver_root, version, buckets), BUCKET, cluster=KEY, replace="dynamic")
