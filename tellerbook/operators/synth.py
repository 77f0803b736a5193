"""Reproducible transactions for backfills and load tests.

Every field is cut from a hash of (seed, id), so a row depends on nothing but
its id: not on the partition count, a retried task or the order of rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.functions.columns import iso_text
from tellerbook.schemas import EVENT, LIVE_TRANSACTION_TYPES, TRANSACTION_TYPES

# The ranges amounts (in cents) and account parts are drawn from.
BACKFILL_CENTS = (1_000, 1_500_000)
LIVE_CENTS = (500, 200_000)
OUTLIER_CENTS = (5_000_000, 10_000_000)
AGENCIES = (100, 999)
ACCOUNTS = (10_000, 99_999)

_UUID_DIGITS = 32
_DRAW_DIGITS = 12
_FIELDS = ("day", "second", "sender", "receiver", "type", "amount", "outlier")


def _draw(field: str, size: int) -> Column:
    """A whole number in [0, size) from the digits reserved for the field."""
    first = _UUID_DIGITS + 1 + _FIELDS.index(field) * _DRAW_DIGITS
    digits = F.substring("_hex", first, _DRAW_DIGITS)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(size).cast("bigint"))


def _between(field: str, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return F.lit(low) + _draw(field, high - low + 1)


def _uuid4() -> Column:
    h = F.col("_hex")
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8),
        F.lit("-"),
        F.substring(h, 9, 4),
        F.lit("-4"),
        F.substring(h, 14, 3),
        F.lit("-"),
        variant,
        F.substring(h, 18, 3),
        F.lit("-"),
        F.substring(h, 21, 12),
    )


def _account(number: Column) -> Column:
    per_agency = ACCOUNTS[1] - ACCOUNTS[0] + 1
    agency = F.floor(number / F.lit(per_agency)) + F.lit(AGENCIES[0])
    account = F.pmod(number, F.lit(per_agency)) + F.lit(ACCOUNTS[0])
    return F.format_string("%d-%d", agency, account)


def transactions_for(
    ids: DataFrame,
    id_column: str,
    start: str,
    days: int,
    seed: int = 0,
    outlier_rate: float | None = None,
) -> DataFrame:
    """One transaction per input id, spread over ``days`` from ``start``.

    With ``outlier_rate`` the rows take the live shape: that share of very
    large amounts, ordinary ones otherwise, and timestamps that name UTC.
    """
    key = F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string"))
    hashed = ids.select(
        F.concat(
            F.sha2(F.concat(key, F.lit(":a")), 256),
            F.sha2(F.concat(key, F.lit(":b")), 256),
        ).alias("_hex")
    )
    first_day = F.lit(date.fromisoformat(start).isoformat()).cast("timestamp_ntz")
    moment = first_day + F.make_dt_interval(
        days=_draw("day", days).cast("int"), secs=_draw("second", 86_400).cast("decimal(18,6)")
    )
    stamp = iso_text(moment)
    accounts = (AGENCIES[1] - AGENCIES[0] + 1) * (ACCOUNTS[1] - ACCOUNTS[0] + 1)
    # A step of 1 .. accounts-1 around the ring never ends on the sender.
    sender = _draw("sender", accounts)
    receiver = F.pmod(sender + F.lit(1) + _draw("receiver", accounts - 1), F.lit(accounts))
    if outlier_rate is None:
        types, cents = TRANSACTION_TYPES, _between("amount", BACKFILL_CENTS)
    else:
        types = LIVE_TRANSACTION_TYPES
        unusual = _draw("outlier", 1_000_000) < F.lit(round(outlier_rate * 1_000_000))
        cents = F.when(unusual, _between("amount", OUTLIER_CENTS)).otherwise(
            _between("amount", LIVE_CENTS)
        )
        stamp = F.concat(stamp, F.lit("+00:00"))
    kinds = F.array(*[F.lit(t) for t in types])
    return hashed.select(
        _uuid4().alias("transaction_id"),
        stamp.alias("timestamp"),
        _account(sender).alias("sender_account"),
        _account(receiver).alias("receiver_account"),
        F.element_at(kinds, (_draw("type", len(types)) + F.lit(1)).cast("int")).alias(
            "transaction_type"
        ),
        (cents / F.lit(100.0)).alias("amount"),
    ).select(*EVENT.fieldNames())


def synthesize_transactions(
    spark: SparkSession,
    n: int = 3_000,
    start: str = "2026-07-07",
    days: int = 6,
    seed: int = 0,
    outlier_rate: float | None = None,
) -> DataFrame:
    """``n`` transactions over ``days`` days; the defaults are the outage week."""
    return transactions_for(spark.range(n), "id", start, days, seed, outlier_rate)
