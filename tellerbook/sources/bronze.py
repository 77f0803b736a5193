"""Bronze: the append-only log of parsed events.

One folder per ingest and batch, below it accepted and quarantined rows, the
accepted ones by transaction type. A batch is written in one pass over its
text, and a replayed batch replaces its own folder, so redelivery after a
crash adds nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerbook.schemas import BRONZE, BRONZE_PARTITIONS, EVENT
from tellerbook.sources.tables import make_folder

ACCEPTED = "accepted"
QUARANTINED = "quarantined"


def ensure_bronze(
    spark: SparkSession, root: str, table: str | None = None, file_format: str = "parquet"
) -> None:
    """Create the folder and, if named, the database and table over it."""
    make_folder(spark, root)
    if table:
        database, _, _ = table.rpartition(".")
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BRONZE)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {file_format} "
            f"PARTITIONED BY ({', '.join(BRONZE_PARTITIONS)}) LOCATION '{root}'"
        )


def refresh_bronze_table(spark: SparkSession, table: str) -> None:
    """Let the catalog table see the folders of batches written since."""
    spark.catalog.recoverPartitions(table)


def append_bronze(
    rows: DataFrame,
    root: str,
    batch_id: int,
    ingest: str = "batch",
    rebalance: bool = False,
    file_format: str = "parquet",
) -> None:
    """Add a batch of parsed events, or of plain event rows.

    Columns beyond the event fields are kept. ``rebalance`` shuffles the batch
    into files of even size; without it every task writes one file per type.
    """
    for name, kind in (("value", "string"), ("reason", "string")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    if "ingested_at" not in rows.columns:
        rows = rows.withColumn("ingested_at", F.current_timestamp())
    good = F.col("reason").isNull()
    placed = rows.withColumn(
        "outcome", F.when(good, F.lit(ACCEPTED)).otherwise(F.lit(QUARANTINED))
    ).withColumn("transaction_type", F.when(good, F.col("transaction_type")))
    if rebalance:
        placed = placed.hint("rebalance", "outcome", "transaction_type")
    (
        placed.write.format(file_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("outcome", "transaction_type")
        .save(f"{root}/ingest={ingest}/batch_id={int(batch_id)}")
    )


def _added_columns(spark: SparkSession, root: str, file_format: str) -> StructType:
    """Columns some batch has beyond the declared ones."""
    reader = spark.read.format(file_format).option("mergeSchema", True)
    merged = reader.option("basePath", root).load(root).schema
    return StructType([f for f in merged if f.name not in BRONZE.fieldNames()])


def _log(
    spark: SparkSession, root: str, file_format: str, added: StructType | None = None
) -> DataFrame:
    schema = StructType([*BRONZE, *(added or [])])
    return spark.read.format(file_format).schema(schema).option("basePath", root).load(root)


def _accepted(log: DataFrame, added: StructType | None = None) -> DataFrame:
    extra = [f.name for f in (added or [])]
    return log.where(F.col("outcome") == ACCEPTED).select(
        *EVENT.fieldNames(), *extra, "ingest", "batch_id", "ingested_at"
    )


def read_bronze(
    spark: SparkSession,
    root: str,
    added: StructType | None = None,
    merge_schema: bool = False,
    file_format: str = "parquet",
) -> DataFrame:
    """All accepted events, with ``ingest``, ``batch_id`` and ``ingested_at``.

    Columns added by later batches are read when declared in ``added``, or
    discovered from the file footers with ``merge_schema``; batches without
    them give NULL.
    """
    if merge_schema:
        added = _added_columns(spark, root, file_format)
    return _accepted(_log(spark, root, file_format, added), added)


def read_bronze_batch(
    spark: SparkSession, root: str, batch_id: int, ingest: str = "batch", file_format: str = "parquet"
) -> DataFrame:
    """The accepted events of one batch; no other folder is listed."""
    path = f"{root}/ingest={ingest}/batch_id={int(batch_id)}"
    rows = spark.read.format(file_format).schema(BRONZE).option("basePath", root).load(path)
    return _accepted(rows)


def read_bronze_table(spark: SparkSession, table: str) -> DataFrame:
    """All accepted events of the catalog table."""
    return _accepted(spark.table(table))


def read_bronze_as_of(
    spark: SparkSession,
    root: str,
    batch_id: int | None = None,
    instant: datetime | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Bronze as it stood after a batch, or at an instant.

    Batch numbers count per ingest; use an instant to look across several.
    """
    rows = read_bronze(spark, root, file_format=file_format)
    if batch_id is not None:
        rows = rows.where(F.col("batch_id") <= int(batch_id))
    if instant is not None:
        rows = rows.where(F.col("ingested_at") <= F.lit(instant))
    return rows


def read_quarantine(
    spark: SparkSession, root: str, file_format: str = "parquet"
) -> DataFrame:
    return (
        _log(spark, root, file_format)
        .where(F.col("outcome") == QUARANTINED)
        .select("value", "reason", "ingest", "batch_id", "ingested_at")
    )
