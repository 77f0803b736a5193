"""Column names, schemas and fixed values shared by every layer."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

KEY = "transaction_id"

# Fixed values.
HIGH_VALUE_THRESHOLD = 10_000.0
TRANSACTION_TYPES = ("PIX", "TED", "CREDIT_CARD", "DEBIT")
LIVE_TRANSACTION_TYPES = ("PIX", "CREDIT_CARD", "TED")
ACCOUNT_PATTERN = r"^\d{3}-\d{5}$"
QUEUE_RETENTION = "7 days"

# A message as it arrives: one flat JSON object.
EVENT = StructType(
    [
        StructField(KEY, StringType()),
        StructField("timestamp", StringType()),
        StructField("sender_account", StringType()),
        StructField("receiver_account", StringType()),
        StructField("transaction_type", StringType()),
        StructField("amount", DoubleType()),
    ]
)
EVENT_TEXT_FIELDS = tuple(f.name for f in EVENT if f.dataType == StringType())

# Fields of a message that EVENT doesn't know, kept on request.
EXTRA = "extra"
WITH_EXTRA = StructType([StructField(EXTRA, VariantType())])

# The append-only log: the message fields, the raw text and reason of rejected
# lines, the trigger time, and the directory levels.
BRONZE_PARTITIONS = ("ingest", "batch_id", "outcome", "transaction_type")
BRONZE = StructType(
    [f for f in EVENT if f.name != "transaction_type"]
    + [
        StructField("value", StringType()),
        StructField("reason", StringType()),
        StructField("ingested_at", TimestampType()),
        StructField("ingest", StringType()),
        StructField("batch_id", LongType()),
        StructField("outcome", StringType()),
        StructField("transaction_type", StringType()),
    ]
)

SILVER = StructType(
    [
        StructField(KEY, StringType()),
        StructField("sender_account", StringType()),
        StructField("receiver_account", StringType()),
        StructField("transaction_type", StringType()),
        StructField("transaction_timestamp", TimestampType()),
        StructField("amount_usd", DoubleType()),
        StructField("is_high_value", BooleanType()),
    ]
)

DATE = "date_transaction"
GOLD_KEYS = (DATE, "account_id", "transaction_type")
GOLD = StructType(
    [
        StructField(DATE, DateType()),
        StructField("account_id", StringType()),
        StructField("transaction_type", StringType()),
        StructField("qty_transactions", LongType()),
        StructField("total_value_usd", DoubleType()),
        StructField("qty_high_level", LongType()),
        StructField("value_high_level", DoubleType()),
    ]
)

# Gold in parts that add up: numbers of rows, whole cents, other amounts and how many.
GOLD_PARTS = StructType(
    [
        StructField("qty", LongType()),
        StructField("n_whole", LongType()),
        StructField("cents", DecimalType(38, 2)),
        StructField("n_rest", LongType()),
        StructField("rest", DoubleType()),
        StructField("n_high", LongType()),
        StructField("high_cents", DecimalType(38, 2)),
        StructField("n_high_rest", LongType()),
        StructField("high_rest", DoubleType()),
    ]
)

# Distinct ids of a day.
SKETCHES = StructType([StructField(DATE, DateType()), StructField("ids", BinaryType())])
