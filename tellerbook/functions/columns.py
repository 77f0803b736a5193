"""Column expressions whose result does not depend on the session time zone
or on the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS_PER_DAY = 86_400


def utc_instant(text: Column) -> Column:
    """ISO-8601 text as an instant; text without a zone is read as UTC.

    Anything that does not start with a full date gives NULL: a bare time or
    year would otherwise be completed from the clock or the calendar.
    """
    text = F.trim(text)
    parsed = F.coalesce(
        F.concat(text, F.lit("Z")).try_cast("timestamp"),
        F.concat(text, F.lit("T00:00:00Z")).try_cast("timestamp"),
        # Only text that names its own zone gets here with a result.
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]"), text.try_cast("timestamp")),
    )
    return F.when(F.substring(text, 5, 1) == "-", parsed)


def utc_date(instant: Column) -> Column:
    """The UTC calendar day of an instant."""
    days = F.floor(F.unix_seconds(instant) / F.lit(_SECONDS_PER_DAY))
    return F.date_from_unix_date(days.cast("int"))


def iso_text(naive: Column) -> Column:
    """A timestamp without zone as ``yyyy-MM-ddTHH:mm:ss[.ffffff]`` text."""
    return F.replace(
        naive.cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T")
    )


def exceeds(amount: Column, threshold: float) -> Column:
    """Strictly above the threshold; false for NULL and NaN."""
    return F.coalesce((amount > F.lit(float(threshold))) & ~F.isnan(amount), F.lit(False))


def whole_cents(amount: Column) -> Column:
    """A DOUBLE amount as a decimal if it is whole cents, else NULL."""
    cents = amount.try_cast("decimal(15,2)")
    return F.when(cents.cast("double") == amount, cents.cast("decimal(18,2)"))


def money_sum(amount: Column) -> Column:
    """Sum of a DOUBLE amount, NULL when every amount is.

    Amounts that are whole cents are added as decimals, so their total does
    not depend on row order; anything else is added as plain doubles. The
    decimal part has room for 10^12 rows of 10^13 each.
    """
    cents = whole_cents(amount)
    exact = F.sum(cents).cast("double")
    rest = F.sum(F.when(cents.isNull(), amount))
    return F.when(exact.isNull(), rest).otherwise(exact + F.coalesce(rest, F.lit(0.0)))
