"""The given tables seen as transaction events: the six text and amount
columns of a message, with timestamps as text without zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _events(
    rows: DataFrame, key: str, time: str, sender: str, receiver: str, kind: str, amount: Column
) -> DataFrame:
    return rows.select(
        F.col(key).cast("string").alias("transaction_id"),
        F.col(time).cast("timestamp_ntz").cast("string").alias("timestamp"),
        F.col(sender).cast("string").alias("sender_account"),
        F.col(receiver).cast("string").alias("receiver_account"),
        F.col(kind).alias("transaction_type"),
        amount.alias("amount"),
    )


def lineitem_events(spark: SparkSession, folder: str) -> DataFrame:
    """Several versions per id, most of them tied on the timestamp's day."""
    return _events(
        table(spark, folder, "lineitem"),
        "l_orderkey", "l_shipdate", "l_suppkey", "l_partkey", "l_returnflag",
        F.col("l_extendedprice"),
    )


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """One version per id."""
    return _events(
        table(spark, folder, "orders"),
        "o_orderkey", "o_orderdate", "o_custkey", "o_orderkey", "o_orderpriority",
        F.col("o_totalprice"),
    )


def click_events(spark: SparkSession, folder: str) -> DataFrame:
    """One version per id, with times inside the day."""
    return _events(
        table(spark, folder, "events"),
        "event_id", "ts", "user_id", "event_id", "event_type",
        F.col("value"),
    )
