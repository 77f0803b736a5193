"""Streaming ingest: landed JSON lines to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellerbook.sources.bronze import append_bronze, ensure_bronze
from tellerbook.sources.events import parse_events, read_event_stream


def ingest_name(batch: DataFrame) -> str:
    """Name of the ingest that a batch belongs to: the id of its query.

    Spark keeps the id in the checkpoint. Batch numbers restart with a new
    checkpoint, even one at the path of an old one; under a new id its batches
    lie beside the earlier ones.
    """
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def write_bronze_stream(
    parsed: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = None,
    rebalance: bool = False,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Append each batch of a parsed stream to bronze.

    Offsets are committed after the batch is written, so delivery is at least
    once; a repeated batch overwrites its own folder. Without ``every`` the
    query takes what is there and stops.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        append_bronze(batch, root, batch_id, ingest_name(batch), rebalance, file_format)

    # Constant within a batch and the same when the batch is replayed.
    stamped = parsed.withColumn("ingested_at", F.current_timestamp())
    writer = stamped.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def run_ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    every: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    missing_text: str | None = None,
    rebalance: bool = False,
    file_format: str = "parquet",
    keep_unknown: bool = False,
) -> StreamingQuery:
    """Ingest a landing folder; bad lines go to quarantine, the rest goes on.

    With ``every`` (such as "10 seconds") the query keeps running; otherwise
    this returns once everything landed so far is in bronze.
    """
    ensure_bronze(spark, root, file_format=file_format)
    lines = read_event_stream(spark, landing, max_files, max_bytes)
    parsed = parse_events(lines, missing_text, keep_unknown)
    query = write_bronze_stream(parsed, root, checkpoint, every, rebalance, file_format)
    if not every:
        query.awaitTermination()
    return query
