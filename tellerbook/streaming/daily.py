"""Low-latency estimates on the stream. The batch gold stays authoritative:
rows later than the watermark are not seen here, and their number is reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tellerbook.functions.columns import money_sum, utc_date
from tellerbook.operators.silver import flag_high_value, silver_cast
from tellerbook.schemas import (
    DATE,
    GOLD,
    GOLD_KEYS,
    HIGH_VALUE_THRESHOLD,
    KEY,
    QUEUE_RETENTION,
    SILVER,
    SKETCHES,
)
from tellerbook.streaming.segments import BATCH, merge_updates, newest_rows, pieces, read_pieces

TIME = "transaction_timestamp"


def stream_silver(events: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Typed and flagged rows of an event stream, not yet de-duplicated."""
    return flag_high_value(silver_cast(events), threshold)


def stream_dedup(
    rows: DataFrame, watermark: str = QUEUE_RETENTION, spread: int = 16
) -> DataFrame:
    """The first arrival of each id within the watermark.

    Copies are thinned out in ``spread`` groups per id first, so one id with
    very many copies is shared by that many tasks instead of filling one.
    ``spread=1`` leaves this step, and its state, out.
    """
    timed = rows.withWatermark(TIME, watermark)
    if spread > 1:
        # Any split is right: whatever passes here is settled below.
        group = F.floor(F.rand(seed=0) * spread).cast("int")
        timed = (
            timed.withColumn("_group", group)
            .dropDuplicatesWithinWatermark([KEY, "_group"])
            .drop("_group")
        )
    return timed.dropDuplicatesWithinWatermark([KEY])


def stream_latest(rows: DataFrame) -> DataFrame:
    """The latest version of each id seen so far, as updates.

    Copies are reduced to one per id and task before the shuffle. The state
    holds every id; use it where the ids are bounded or the store is large.
    """
    rest = [c for c in rows.columns if c not in (KEY, TIME)]
    version = F.struct(TIME, *rest)
    latest = rows.groupBy(KEY).agg(F.max(version).alias("_latest"))
    return latest.select(KEY, "_latest.*").select(*rows.columns)


def stream_gold(unique_rows: DataFrame) -> DataFrame:
    """The gold metrics per day over a stream of unique rows."""
    amount, high = F.col("amount_usd"), F.col("is_high_value")
    return (
        unique_rows.groupBy(
            F.window(TIME, "1 day").alias("_day"),
            F.col("sender_account").alias("account_id"),
            "transaction_type",
        )
        .agg(
            F.count(KEY).alias("qty_transactions"),
            money_sum(amount).alias("total_value_usd"),
            F.count_if(high).alias("qty_high_level"),
            money_sum(F.when(high, amount).otherwise(F.lit(0.0))).alias("value_high_level"),
        )
        .withColumn(DATE, utc_date(F.col("_day.start")))
        .select(*GOLD.fieldNames())
    )


def write_updates(
    updates: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    keys: tuple[str, ...] | None = None,
    most: int = 8,
) -> StreamingQuery:
    """Write each batch of changed rows to its own folder, replays replacing it.

    A path belongs to one checkpoint. With ``keys``, old batches are merged as the log
    grows, so that it keeps about ``most`` folders.
    """
    schema = updates.schema

    def land(batch: DataFrame, batch_id: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .parquet(f"{path}/batch_id={int(batch_id)}")
        )
        if keys:
            merge_updates(batch.sparkSession, path, schema, keys, most)

    writer = (
        updates.writeStream.outputMode("update")
        .foreachBatch(land)
        .option("checkpointLocation", checkpoint)
    )
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _latest_updates(
    spark: SparkSession, path: str, schema: StructType, keys: tuple[str, ...]
) -> DataFrame:
    rows = read_pieces(spark, path, schema, pieces(spark, path))
    return newest_rows(rows, schema, keys).drop(BATCH)


def read_stream_gold(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every gold row written by ``write_updates``."""
    return _latest_updates(spark, path, GOLD, GOLD_KEYS)


def read_stream_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every id written by ``write_updates``."""
    return _latest_updates(spark, path, SILVER, (KEY,))


def read_stream_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The newest sketch of each day written by ``write_updates``."""
    return _latest_updates(spark, path, SKETCHES, (DATE,))


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows the query left out, over the progress Spark still keeps."""
    return sum(
        int(operator.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
