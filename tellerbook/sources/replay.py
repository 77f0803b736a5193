"""Replay of what landed within a window of time: bronze gains only what it lacks.

A landing folder keeps its files for the retention. After a fault of the ingest the
files of a window are read again; lines that bronze has are recognised by the digest of
their fields and left out.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.schemas import EVENT
from tellerbook.session import working_folder
from tellerbook.sources.bronze import append_bronze, ensure_bronze, read_bronze, read_quarantine
from tellerbook.sources.events import parse_events
from tellerbook.sources.tables import numbered

INGEST = "replay"


def read_events_between(spark: SparkSession, landing: str, after: datetime, before: datetime) -> DataFrame:
    """Lines of the files modified later than ``after`` and earlier than ``before``.

    Other files are left out when the folder is listed; none of them is opened.
    """
    def text(moment: datetime) -> str:
        return moment.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%f")

    reader = spark.read.option("modifiedAfter", text(after)).option("modifiedBefore", text(before))
    return reader.option("timeZone", "UTC").text(landing)


def _digest(fields: list[str]) -> Column:
    """A digest of these columns' values, NULL apart from any text."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def replay(
    spark: SparkSession, landing: str, bronze_root: str, after: datetime, before: datetime, missing_text: str | None = None
) -> int:
    """Append what landed in the window and is not in bronze; returns the number of rows.

    Compared with what was ingested since the window began, as nothing of it can have
    been ingested earlier; files of older batches are skipped by their statistics. A
    line that landed twice and is in bronze once is not lacking. Repeating a replay, also an
    interrupted one, appends only what is still lacking.
    """
    ensure_bronze(spark, bronze_root)
    names = EVENT.fieldNames()
    rows = parse_events(read_events_between(spark, landing, after, before), missing_text)
    good = F.col("reason").isNull()
    marked = rows.withColumn("_digest", F.when(good, _digest(names)).otherwise(_digest(["value"])))
    since = F.col("ingested_at") >= F.lit(after)
    held = (
        read_bronze(spark, bronze_root).where(since).select(_digest(names).alias("_digest"))
        .union(read_quarantine(spark, bronze_root).where(since).select(_digest(["value"])))
        .distinct()
    )
    lacking = marked.join(held, "_digest", "left_anti").drop("_digest")
    # Written first: the log is read to find what it lacks, and must not be written meanwhile.
    work = working_folder(spark, "replay")
    lacking.write.parquet(work)
    staged = spark.read.schema(lacking.schema).parquet(work)
    n = staged.count()
    if n:
        used = [number for number, _ in numbered(spark, f"{bronze_root}/ingest={INGEST}", "batch_id=")]
        append_bronze(staged, bronze_root, max(used, default=-1) + 1, INGEST)
    return n


def last_arrival(spark: SparkSession, landing: str) -> datetime | None:
    """When the newest file landed, by the store's own clock; file contents are not read."""
    files = spark.read.format("binaryFile").load(landing)
    micros = files.agg(F.unix_micros(F.max("modificationTime"))).head()[0]
    return None if micros is None else datetime.fromtimestamp(micros / 1e6, UTC)
