"""Update logs that stay short: batch folders merged into segments, step by step.

A segment holds the newest row of each key among a stretch of batches, with the number
of its batch, beside the log in ``<path>-merged/<first>-<last>``. A reader takes the
complete segments that no larger one covers and the batches behind them, so it sees the
same rows before and after a merge. What a segment covers is removed by the next merge
only, when readers of the earlier state have gone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tellerbook.sources.tables import complete, exists, folder_bytes, folder_names, remove_folder

BATCH = "batch_id"


@dataclass(frozen=True)
class Piece:
    """A stretch of batches in one folder: a segment or a single batch."""

    first: int
    last: int
    path: str
    segment: bool

    def covers(self, other: Piece) -> bool:
        wider = self.last - self.first > other.last - other.first or self.segment > other.segment
        return self.segment and wider and self.first <= other.first and other.last <= self.last


def _logged(schema: StructType) -> StructType:
    return StructType([*schema, StructField(BATCH, LongType())])


def _all_pieces(spark: SparkSession, path: str) -> list[Piece]:
    root = f"{path}-merged"
    found = []
    for name in folder_names(spark, root):
        if exists(spark, f"{root}/{name}/_SUCCESS"):
            first, last = name.split("-")
            found.append(Piece(int(first), int(last), f"{root}/{name}", True))
    batches = complete(spark, path, f"{BATCH}=")
    return found + [Piece(n, n, f"{path}/{BATCH}={n}", False) for n in batches]


def pieces(spark: SparkSession, path: str) -> list[Piece]:
    """What a reader takes: complete pieces that no other covers, the oldest first."""
    every = _all_pieces(spark, path)
    return sorted((p for p in every if not any(q.covers(p) for q in every)), key=lambda p: p.first)


def read_pieces(spark: SparkSession, path: str, schema: StructType, found: list[Piece]) -> DataFrame:
    """The rows of these pieces with the number of their batch."""
    logged = _logged(schema)
    segments = [p.path for p in found if p.segment]
    batches = [p.path for p in found if not p.segment]
    rows = spark.createDataFrame([], logged)
    if batches:
        rows = spark.read.schema(logged).option("basePath", path).parquet(*batches)
    if segments:
        rows = rows.unionByName(spark.read.schema(logged).parquet(*segments))
    return rows


def newest_rows(rows: DataFrame, schema: StructType, keys: tuple[str, ...]) -> DataFrame:
    """The newest row of each key, with the number of its batch."""
    values = [c for c in schema.fieldNames() if c not in keys]
    newest = F.max(F.struct(BATCH, *values)).alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*schema.fieldNames(), BATCH)


def _planned(spark: SparkSession, found: list[Piece]) -> list[Piece]:
    """The newest pieces whose sizes do not fall behind: so each row is merged a few times.

    Going back in time, a piece joins while it is no larger than all newer ones
    together. What stays is ever larger the older it is: as many pieces as the size
    of the log doubles.
    """
    run, size = [], 0
    for piece in reversed(found):
        own = folder_bytes(spark, piece.path)
        if len(run) >= 2 and own > size:
            break
        run.append(piece)
        size += own
    return run[::-1]


def merge_updates(spark: SparkSession, path: str, schema: StructType, keys: tuple[str, ...], most: int = 8) -> int:
    """Merge old batches if there are more than ``most`` pieces; the number merged.

    The newest batch stays out, as it may be written again. An interrupted merge
    leaves a segment without _SUCCESS, which no reader takes and the next one replaces.
    One merge at a time; it may run beside the stream.
    """
    every = _all_pieces(spark, path)
    live = pieces(spark, path)
    for piece in every:
        if piece not in live:
            remove_folder(spark, piece.path)
    settled = live[:-1]
    if len(settled) < max(2, most):
        return 0
    run = _planned(spark, settled)
    rows = newest_rows(read_pieces(spark, path, schema, run), schema, keys)
    target = f"{path}-merged/{run[0].first}-{run[-1].last}"
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
    return len(run)
