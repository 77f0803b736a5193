"""Data-quality checks and the gate before gold.

Checks on single rows are plain predicates, so any number of them shares one
pass, or rides along with a write. Checks on keys pre-aggregate before they
shuffle, so one key holding a large share of the rows is no hot spot.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tellerbook.schemas import ACCOUNT_PATTERN, KEY, TRANSACTION_TYPES


class QualityError(Exception):
    """A check of level ``error`` found failing rows."""


@dataclass(frozen=True)
class RowCheck:
    """A named predicate that is true on failing rows."""

    name: str
    fails: Column
    level: str = "error"


def not_null(*columns: str) -> list[RowCheck]:
    return [RowCheck(f"not_null:{c}", F.col(c).isNull()) for c in columns]


def accepted_values(column: str, values: Sequence[str], level: str = "warn") -> RowCheck:
    """Values outside the list; NULL passes, as ``not_null`` covers it."""
    return RowCheck(f"accepted_values:{column}", ~F.col(column).isin(*values), level)


def expression(name: str, holds: Column, level: str = "warn") -> RowCheck:
    """Rows on which the condition is false; an unknown result passes."""
    return RowCheck(f"expression:{name}", ~holds, level)


def silver_checks() -> list[RowCheck]:
    """The checks silver must pass before gold is built."""
    amount = F.col("amount_usd")
    infinite = F.abs(amount) == F.lit(float("inf"))
    return [
        *not_null(KEY, "transaction_timestamp", "sender_account", "transaction_type"),
        accepted_values("transaction_type", TRANSACTION_TYPES),
        expression("amount_not_negative", amount >= 0),
        expression("amount_finite", ~(F.isnan(amount) | infinite), "error"),
        expression("sender_format", F.col("sender_account").rlike(ACCOUNT_PATTERN)),
        expression("receiver_format", F.col("receiver_account").rlike(ACCOUNT_PATTERN)),
        expression(
            "sender_is_not_receiver",
            F.col("sender_account") != F.col("receiver_account"),
        ),
    ]


def _failing(checks: Sequence[RowCheck]) -> list[Column]:
    return [F.count_if(c.fails).alias(c.name) for c in checks]


def run_row_checks(rows: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Every row check in one pass: (check, level, failing_rows)."""
    counted = rows.agg(*_failing(checks))
    lines = [
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.level).alias("level"),
            F.col(f"`{c.name}`").alias("failing_rows"),
        )
        for c in checks
    ]
    return counted.select(F.inline(F.array(*lines)))


def observe_row_checks(
    rows: DataFrame, checks: Sequence[RowCheck], name: str
) -> tuple[DataFrame, Observation]:
    """Attach the checks to a DataFrame about to be written, at no extra pass.

    Put this last before the write: metrics gathered before a shuffle are
    counted again when lost shuffle files are recomputed.
    """
    seen = Observation(name)
    return rows.observe(seen, F.count("*").alias("rows"), *_failing(checks)), seen


def check_not_null(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return run_row_checks(rows, not_null(*columns))


def check_accepted_values(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return run_row_checks(rows, [accepted_values(column, values)])


def check_expression(rows: DataFrame, name: str, holds: Column) -> DataFrame:
    return run_row_checks(rows, [expression(name, holds)])


def check_unique(rows: DataFrame, key: str) -> DataFrame:
    """Number of non-NULL keys that occur more than once."""
    repeated = (
        rows.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1)
    )
    return repeated.agg(F.count("*").alias("failing_rows")).select(
        F.lit(f"unique:{key}").alias("check"),
        F.lit("error").alias("level"),
        "failing_rows",
    )


def check_relationship(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Number of child rows whose non-NULL key has no parent.

    Both sides are reduced to one row per key before the join.
    """
    per_key = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_key"))
        .agg(F.count("*").alias("_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("_key")).distinct()
    orphans = per_key.join(parents, "_key", "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("failing_rows")
    ).select(
        F.lit(f"relationship:{child_key}").alias("check"),
        F.lit("error").alias("level"),
        "failing_rows",
    )


def gate(results: Iterable[tuple[str, str, int]]) -> None:
    """Raise when a check of level ``error`` failed. Takes one line per check."""
    failed = [f"{check} ({rows})" for check, level, rows in results if level == "error" and rows]
    if failed:
        raise QualityError("quality gate closed: " + ", ".join(failed))
