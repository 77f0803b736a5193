"""Gold: daily metrics per sender account and transaction type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerbook.functions.columns import money_sum, utc_date, whole_cents
from tellerbook.schemas import DATE, GOLD, GOLD_KEYS, GOLD_PARTS, KEY


def gold_account_summary(silver: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Volume and value per day, account and type, and the high-value share.

    ``unique_ids`` says the input holds each id once, as ``build_silver``
    guarantees; counting rows then equals counting distinct ids and saves an
    aggregation over every id.
    """
    ids = F.count(KEY) if unique_ids else F.countDistinct(KEY)
    amount = F.col("amount_usd")
    high = F.col("is_high_value")
    return (
        silver.select(
            utc_date(F.col("transaction_timestamp")).alias(DATE),
            F.col("sender_account").alias("account_id"),
            "transaction_type",
            KEY,
            "amount_usd",
            "is_high_value",
        )
        .groupBy(DATE, "account_id", "transaction_type")
        .agg(
            ids.alias("qty_transactions"),
            money_sum(amount).alias("total_value_usd"),
            F.count_if(high).alias("qty_high_level"),
            money_sum(F.when(high, amount).otherwise(F.lit(0.0))).alias("value_high_level"),
        )
        .select(*GOLD.fieldNames())
    )


def gold_parts(rows: DataFrame) -> DataFrame:
    """What gold is made of, in parts that can be added and taken away again.

    Rows are silver rows with a ``sign``: +1 counts a row in, -1 takes it out. Whole
    cents are added as decimals, so a row taken out leaves nothing behind; other amounts
    are added as doubles, with their number, and count as 0.0 once none is left.
    """
    sign, amount, high = F.col("sign"), F.col("amount_usd"), F.col("is_high_value")
    cents = whole_cents(amount)
    whole, rest = cents.isNotNull(), amount.isNotNull() & cents.isNull()

    def times(condition, value=None):
        return F.sum(F.when(condition, sign if value is None else sign * value))

    return _typed(
        rows.groupBy(
            utc_date(F.col("transaction_timestamp")).alias(DATE),
            F.col("sender_account").alias("account_id"),
            "transaction_type",
        ).agg(
            F.sum("sign").alias("qty"),
            times(whole).alias("n_whole"),
            times(whole, cents).alias("cents"),
            times(rest).alias("n_rest"),
            times(rest, amount).alias("rest"),
            times(high).alias("n_high"),
            times(high & whole, cents).alias("high_cents"),
            times(high & rest).alias("n_high_rest"),
            times(high & rest, amount).alias("high_rest"),
        )
    )


def _typed(parts: DataFrame) -> DataFrame:
    return parts.select(
        *GOLD_KEYS, *[F.coalesce(F.col(f.name), F.lit(0)).cast(f.dataType).alias(f.name) for f in GOLD_PARTS]
    )


def add_parts(parts: DataFrame) -> DataFrame:
    """One row per key: the sum of its parts."""
    names = [f.name for f in GOLD_PARTS]
    return _typed(parts.groupBy(*GOLD_KEYS).agg(*[F.sum(c).alias(c) for c in names]))


def gold_from_parts(parts: DataFrame) -> DataFrame:
    """Gold of the keys that still have rows; equals ``gold_account_summary`` of these rows."""
    rest = F.when(F.col("n_rest") > 0, F.col("rest"))
    high_rest = F.when(F.col("n_high_rest") > 0, F.col("high_rest")).otherwise(F.lit(0.0))
    exact = F.col("cents").cast("double")
    total = F.when(F.col("n_whole") > 0, exact + F.coalesce(rest, F.lit(0.0))).otherwise(rest)
    return parts.where(F.col("qty") > 0).select(
        *GOLD_KEYS,
        F.col("qty").alias("qty_transactions"),
        total.alias("total_value_usd"),
        F.col("n_high").alias("qty_high_level"),
        (F.col("high_cents").cast("double") + high_rest).alias("value_high_level"),
    )
