"""Gold kept right by the stream itself: days close at a frontier, late rows repair them.

The frontier is a date that moves with the newest event time. Rows ahead of it wait, by
day; once it passes a day, the day's rows go to silver and gold together. Rows that
arrive behind it go there at once, as signed differences. So nothing is left out,
however late it comes, and gold of closed days is that of a rebuild after every batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tellerbook.functions.columns import utc_date, utc_instant
from tellerbook.plans.deltas import fold_changes, refresh_gold_deltas
from tellerbook.plans.pipeline import run_pipeline
from tellerbook.plans.stored import change_numbers
from tellerbook.schemas import EVENT, HIGH_VALUE_THRESHOLD
from tellerbook.sources.bronze import append_bronze, ensure_bronze, read_bronze_batch
from tellerbook.sources.events import parse_events, read_event_stream
from tellerbook.sources.tables import complete, current_version, numbered, remove_folder, versions
from tellerbook.streaming.ingest import ingest_name

DAY = "day"
#: The day of rows whose time cannot be read; they never wait.
NO_DAY = -1
_WAITING = StructType([*EVENT, StructField(DAY, IntegerType()), StructField("batch_id", LongType())])


class LiveGold:
    """The folders of one stream: bronze, silver, gold, and what waits for its day to close."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        lateness_days: int = 1,
        threshold: float = HIGH_VALUE_THRESHOLD,
        buckets: int = 64,
        fold_after: int = 16,
    ) -> None:
        self.spark = spark
        self.bronze, self.silver, self.gold = (f"{root}/{n}" for n in ("bronze", "silver", "gold"))
        self.waiting, self.frontiers, self.checkpoint = (f"{root}/{n}" for n in ("waiting", "frontier", "checkpoint"))
        self.lateness_days, self.threshold = lateness_days, threshold
        self.buckets, self.fold_after = buckets, fold_after

    # The frontier: days since 1970, one small file a batch, of which the last is kept.

    def _frontier_root(self, ingest: str) -> str:
        return f"{self.frontiers}/ingest={ingest}"

    def _frontier_before(self, ingest: str, batch_id: int) -> int | None:
        root = self._frontier_root(ingest)
        earlier = [n for n in complete(self.spark, root, "batch_id=") if n < batch_id]
        if not earlier:
            return None
        return self.spark.read.schema("frontier int").parquet(f"{root}/batch_id={earlier[-1]}").head()[0]

    def _write_frontier(self, ingest: str, batch_id: int, frontier: int | None) -> None:
        root = self._frontier_root(ingest)
        row = self.spark.range(1).select(F.lit(frontier).cast("int").alias("frontier"))
        row.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
        for number, _ in numbered(self.spark, root, "batch_id="):
            if number < batch_id - 1:
                remove_folder(self.spark, f"{root}/batch_id={number}")

    def _waiting_rows(self, closed: Column) -> DataFrame:
        rows = self.spark.read.schema(_WAITING).parquet(self.waiting) if self._waiting_days() else None
        none = self.spark.createDataFrame([], EVENT)
        return none if rows is None else rows.where(closed).select(*EVENT.fieldNames())

    def _waiting_days(self) -> list[int]:
        return [n for n, _ in numbered(self.spark, self.waiting, f"{DAY}=")]

    def _remove_days(self, before: int | None = None) -> None:
        for day in self._waiting_days():
            if before is None or day < before:
                remove_folder(self.spark, f"{self.waiting}/{DAY}={day}")

    def start(self) -> None:
        """Make empty tables where there are none."""
        ensure_bronze(self.spark, self.bronze)
        if not any(done for _, done in versions(self.spark, self.gold)):
            run_pipeline(self.spark, self.bronze, self.silver, self.gold, self.threshold, buckets=self.buckets)

    def take(self, parsed: DataFrame, batch_id: int, ingest: str) -> None:
        """One batch: log it, split it at the frontier, repair and close days, move on.

        A batch that is taken again finds the frontier of the batch before it and does
        the same; what silver has already changes nothing.
        """
        append_bronze(parsed, self.bronze, batch_id, ingest)
        day = F.coalesce(F.unix_date(utc_date(utc_instant(F.col("timestamp")))), F.lit(NO_DAY))
        rows = read_bronze_batch(self.spark, self.bronze, batch_id, ingest)
        rows = rows.select(*EVENT.fieldNames(), day.alias(DAY))

        before = self._frontier_before(ingest, batch_id)
        # One number.
        newest = rows.agg(F.max(DAY)).head()[0]
        reached = None if newest is None or newest == NO_DAY else newest - self.lateness_days
        frontier = max((x for x in (before, reached) if x is not None), default=None)
        if frontier is not None:
            ahead = rows.where(F.col(DAY) >= frontier).withColumn("batch_id", F.lit(batch_id).cast("long"))
            (
                ahead.select(*_WAITING.fieldNames())
                .hint("rebalance", DAY)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(DAY, "batch_id")
                .parquet(self.waiting)
            )
            behind = rows.where(F.col(DAY) < frontier).select(*EVENT.fieldNames())
            self._repair(behind.unionByName(self._waiting_rows(F.col(DAY) < frontier)))
        else:
            self._repair(rows.select(*EVENT.fieldNames()))
        self._write_frontier(ingest, batch_id, frontier)
        if frontier is not None:
            self._remove_days(frontier)

    def _repair(self, rows: DataFrame) -> None:
        refresh_gold_deltas(self.spark, rows, self.silver, self.gold, self.threshold)
        version = current_version(self.spark, self.gold)
        if len(change_numbers(self.spark, self.silver, version)) >= self.fold_after:
            fold_changes(self.spark, self.silver, self.gold)

    def close_days(self) -> None:
        """Bring all waiting rows to silver and gold, such as when the source has ended."""
        self._repair(self._waiting_rows(F.lit(True)))
        self._remove_days()


def run_live_gold(
    live: LiveGold, landing: str, every: str | None = None, max_files: int | None = None
) -> StreamingQuery:
    """Keep gold up to date with a landing folder.

    With ``every`` the query keeps running; otherwise it takes what is there and stops.
    Bad lines are quarantined in bronze. One query per ``LiveGold``.
    """
    live.start()
    parsed = parse_events(read_event_stream(live.spark, landing, max_files))
    stamped = parsed.withColumn("ingested_at", F.current_timestamp())

    def land(batch: DataFrame, batch_id: int) -> None:
        live.take(batch, batch_id, ingest_name(batch))

    writer = stamped.writeStream.foreachBatch(land).option("checkpointLocation", live.checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
