"""The latest version of each id on the stream, with state that is given back.

An id's state is its latest row. Once the watermark passes that row's time by the
retention, no version of it that the queue still holds can be newer, and a timer drops
the state. Ids share buckets by hash: a bucket's rows are read and written at once, and it has
one timer, so the calls to the state store do not grow with the ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tellerbook.schemas import KEY, QUEUE_RETENTION, SILVER
from tellerbook.session import SETTINGS, STATE_STORE, ship_package

TIME = "transaction_timestamp"
# Times go through Python as microseconds, which no zone can change.
MICROS = "micros"
_REST = [f for f in SILVER if f.name not in (KEY, TIME)]
_NAMES = [MICROS, *[f.name for f in _REST]]
_STATE = f"{MICROS} bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _REST)
_BUCKET = "_bucket"
_HELD = f"held array<struct<{KEY}: string, " + _STATE.replace(" ", ": ").replace(",:", ",") + ">>"


def _rank(values: tuple) -> tuple:
    """Orders rows as Spark orders structs: NULL first, NaN behind all numbers."""
    return tuple(
        (v is not None, isinstance(v, float) and math.isnan(v), 0 if v is None or v != v else v) for v in values
    )


class LatestVersion(StatefulProcessor):
    """Emits an id's row when it becomes the latest; forgets the id after the retention.

    The key is a bucket of ids; rows are (bucket, id, micros, other columns, time).
    """

    def __init__(self, retention_ms: int) -> None:
        self.retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", _HELD)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best: dict = {}
        for row in rows:
            id, values = row[1], tuple(row[2 : 2 + len(_NAMES)])
            other = best.get(id)
            if other is None or _rank(values) > _rank(other):
                best[id] = values
        held = self._held()
        before = self._due(held)
        newer = {id: v for id, v in best.items() if id not in held or _rank(v) > _rank(held[id])}
        if not newer:
            return
        held.update(newer)
        self._keep(held)
        due = self._due(held)
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(due)
        for id, values in newer.items():
            yield Row(**{KEY: id}, **dict(zip(_NAMES, values, strict=True)))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        held = {id: values for id, values in self._held().items() if self._due_of(values) > passed}
        if held:
            self._keep(held)
            self.handle.registerTimer(self._due(held))
        else:
            self.latest.clear()
        return iter(())

    def _held(self) -> dict:
        state = self.latest.get()
        return {} if state is None else {row[0]: tuple(row[1:]) for row in state[0]}

    def _keep(self, held: dict) -> None:
        self.latest.update(([(id, *values) for id, values in held.items()],))

    def _due_of(self, values: tuple) -> int:
        return values[0] // 1000 + 1 + self.retention_ms

    def _due(self, held: dict) -> int | None:
        """When the first of these rows is to be forgotten."""
        return min(map(self._due_of, held.values()), default=None)

    def close(self) -> None:
        pass


def stream_latest_bounded(
    rows: DataFrame,
    watermark: str = QUEUE_RETENTION,
    retention: timedelta = timedelta(days=7),
    buckets: int = 1 << 17,
) -> DataFrame:
    """The latest version of each id, as updates, with ids forgotten after the retention.

    Rows behind the watermark, or without a time, are left out: they belong to a refresh.
    A version that comes after its id was forgotten counts as the first; readers of
    the updates keep the latest per id, so an older one of them still loses if the reader
    compares times (see ``read_latest_by_time``). Needs the RocksDB state store, which it
    selects for the session; streams that have a checkpoint keep theirs. An arriving row
    rewrites its bucket: a hundred or two ids a bucket are quick. The number of buckets must stay
    the same for a checkpoint; the rows of state that Spark reports are buckets.
    """
    rows.sparkSession.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    ship_package(rows.sparkSession)
    timed = rows.where(F.col(TIME).isNotNull()).withWatermark(TIME, watermark)
    latest = (
        timed.withColumn(MICROS, F.unix_micros(TIME))
        .withColumn(_BUCKET, F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int"))
        .select(_BUCKET, KEY, *_NAMES, TIME)
        .groupBy(_BUCKET)
        .transformWithState(
            statefulProcessor=LatestVersion(int(retention.total_seconds() * 1000)),
            outputStructType=f"{KEY} string, {_STATE}",
            outputMode="Update",
            timeMode="EventTime",
        )
    )
    return latest.withColumn(TIME, F.timestamp_micros(MICROS)).select(*SILVER.fieldNames())


def read_latest_by_time(updates: DataFrame) -> DataFrame:
    """The latest row of each id among written updates, by time and then all other columns."""
    version = F.struct(TIME, *[f.name for f in _REST])
    newest = updates.groupBy(KEY).agg(F.max(version).alias("_row"))
    return newest.select(KEY, "_row.*").select(*SILVER.fieldNames())
