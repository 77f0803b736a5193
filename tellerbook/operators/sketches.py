"""Distinct ids that add up: mergeable sketches per day, united over any range.

An exact distinct count of a month cannot be made of those of its days, and a stream
rejects it. A sketch can: it has a fixed size, is made in the tasks before any exchange,
and the union of two is the sketch of both sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerbook.functions.columns import utc_date
from tellerbook.schemas import DATE

TIME = "transaction_timestamp"
#: 2^LOG2 registers: a standard error of 1.04 / sqrt(2^LOG2), 0.8 %, in 10 KB a sketch.
LOG2 = 14
#: What an estimate may be off, as a share: four standard errors.
BOUND = 4 * 1.04 / 2 ** (LOG2 / 2)
SKETCH = "ids"


def daily_sketches(silver: DataFrame, column: str = "sender_account") -> DataFrame:
    """(date, sketch) of the distinct values of a column on each day; NULL counts as none."""
    return silver.groupBy(utc_date(F.col(TIME)).alias(DATE)).agg(
        F.hll_sketch_agg(column, F.lit(LOG2)).alias(SKETCH)
    )


def stream_sketches(rows: DataFrame, column: str = "sender_account", watermark: str = "7 days") -> DataFrame:
    """The same on a stream, as updates of each day's sketch.

    The state is one sketch a day, whatever the number of rows, until the watermark
    passes the day. Copies of a row change nothing.
    """
    day = F.window(TIME, "1 day").alias("_day")
    daily = rows.withWatermark(TIME, watermark).groupBy(day).agg(F.hll_sketch_agg(column, F.lit(LOG2)).alias(SKETCH))
    return daily.select(utc_date(F.col("_day.start")).alias(DATE), SKETCH)


def united(sketches: DataFrame, by: Column) -> DataFrame:
    """Estimated numbers of distinct ids of groups of days, and the range they lie in.

    Any grouping of the days will do, such as months, weeks or the whole. The range
    is the estimate plus and minus ``BOUND``.
    """
    estimate = F.hll_sketch_estimate(F.hll_union_agg(SKETCH))
    counted = sketches.groupBy(by.alias("period")).agg(estimate.alias("estimate"))
    share = F.col("estimate") * F.lit(BOUND)
    return counted.select(
        "period",
        "estimate",
        F.floor(F.col("estimate") - share).cast("long").alias("at_least"),
        F.ceil(F.col("estimate") + share).cast("long").alias("at_most"),
    )
