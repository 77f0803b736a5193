"""Rows dealt out by a key, handed to Python group by group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerbook.llm.store import few_tasks


def _spans(key: pa.Array) -> list[int]:
    values = np.asarray(key)
    return [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]


def each_group(
    rows: DataFrame, key: str, function: Callable[[pa.Table], Iterator[dict]], schema: str, *order: str
) -> DataFrame:
    """Apply ``function`` to the rows of each value of the long column ``key``.

    Rows are dealt out by the key and sorted by it and ``order``. Groups must be of
    bounded size, which is the caller's duty; tasks hold one group and one Arrow
    batch at a time. ``function`` yields dicts of columns.
    """
    dealt = rows.repartition(F.col(key)).sortWithinPartitions(key, *order)
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[dict] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_pydict({n: _joined([o[n] for o in out]) for n in names})
                out.clear()

        def done(parts: list[pa.RecordBatch]) -> None:
            out.extend(function(pa.Table.from_batches(parts)))

        for batch in batches:
            if not batch.num_rows:
                continue
            at = _spans(batch.column(key))
            if held and held[0].column(key)[0] != batch.column(key)[0]:
                done(held)
                held = []
            for a, b in zip(at[:-2], at[1:-1], strict=True):
                done([*held, batch.slice(a, b - a)])
                held = []
            held.append(batch.slice(at[-2], at[-1] - at[-2]))
            if len(out) >= 256:
                yield from flush()
        if held:
            done(held)
        yield from flush()

    return few_tasks(dealt).mapInArrow(run, schema)


def _joined(parts: list) -> pa.Array:
    if isinstance(parts[0], np.ndarray):
        return pa.array(np.concatenate(parts))
    return pa.array([x for part in parts for x in part])
