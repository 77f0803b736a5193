"""Near-duplicate vectors: tile products of int8 codes with rigorous error bounds.

A unit vector x is held as s * q + e, q of whole numbers from -127 to 127. For two
vectors, |x.y - s t (q.r)| <= |f| + |e| (1 + |f|), where e and f are the exact
quantisation errors' norms. A tile product therefore tells which pairs may reach
the threshold; only these are recomputed in double precision.

Vectors of a label are dealt into blocks of about ``TILE``; each pair of blocks is
one group of work. Equal vectors are one vector with a count. That is exact for any
distribution; the number of tile products grows with the square of a label's
distinct vectors, divided by ``TILE`` squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerbook.llm.graph import components
from tellerbook.llm.groups import each_group
from tellerbook.llm.store import need_columns, stored

TILE = 1024


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and the norms of the errors of unit vectors."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, error


def close_pairs(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows with at least this cosine, in double precision."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
    long_x, long_y = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    q, s, e = quantised(x / long_x[:, None])
    r, t, f = quantised(y / long_y[:, None])
    # Products of codes are whole numbers, exact in this type.
    kind = np.float32 if x.shape[1] <= 1024 else np.float64
    product = (q.astype(kind) @ r.astype(kind).T).astype(np.float64) * np.outer(s, t)
    slack = f[None, :] + e[:, None] * (1 + f[None, :]) + 1e-9
    i, j = np.nonzero(product + slack >= cosine)
    keep = np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 16):
        b, c = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
        keep[a : a + (1 << 16)] = (x[b] * y[c]).sum(axis=1) / (long_x[b] * long_y[c]) >= cosine
    return i[keep], j[keep]


def _spread(linked: np.ndarray) -> Iterator[np.ndarray]:
    """The components of a symmetric matrix of links, of two members or more."""
    open_ = linked.any(axis=1)
    while open_.any():
        start = int(np.argmax(open_))
        members, edge = np.zeros(len(linked), bool), np.array([start])
        members[start] = True
        while len(edge):
            reached = linked[edge].any(axis=0) & ~members
            members |= reached
            edge = np.flatnonzero(reached)
        open_ &= ~members
        yield np.flatnonzero(members)


def _tiles(cosine: float):
    def function(rows: pa.Table) -> Iterator[dict]:
        ids, counts = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        flat = rows.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(len(ids), -1)
        n, linked = len(ids), np.zeros((len(ids), len(ids)), bool)
        blocks = rows.column("block").to_numpy()
        if rows.column("two_blocks")[0].as_py():
            one, two = np.flatnonzero(blocks == blocks.min()), np.flatnonzero(blocks != blocks.min())
        else:
            one = two = np.arange(n)
        if len(one) and len(two):
            i, j = close_pairs(x[one], x[two], cosine)
            linked[one[i], two[j]] = True
            linked[two[j], one[i]] = True
            np.fill_diagonal(linked, False)
        if linked.any():
            links = linked @ counts
            some = links > 0
            yield {"a": ids[some], "b": ids[some], "links": links[some]}
            for members in _spread(linked):
                a = np.full(len(members) - 1, ids[members[0]])
                yield {"a": a, "b": ids[members[1:]], "links": np.zeros(len(a), np.int64)}

    return function


def _usable(vector: str, kind: str) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast(kind))

    held = F.col(vector)
    return F.forall(held, finite) & F.exists(held, lambda x: x != 0)


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Links between vectors of equal label with at least this cosine.

    Returns vec_id, n_links (other rows linked directly), component_id (the
    smallest vec_id reachable) and kept for every row. Null labels, vectors that are
    null, empty, zero or of other length, and null or non-finite components link
    with nothing, nor does a null vec_id. Repeated rows are linked with each other.
    Further columns play no part; an empty table stays empty.
    """
    rows = need_columns(vectors, "vec_id", "embedding", "label").withColumn("vec_id", F.col("vec_id").cast("long"))
    kind = rows.schema["embedding"].dataType.elementType.simpleString()
    good = rows.where("vec_id IS NOT NULL AND label IS NOT NULL").where(_usable("embedding", kind))
    same = ["label", "embedding"]
    reps = good.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = stored(reps.withColumn("length", F.size("embedding")), "vectors")
    sizes = reps.groupBy("label", "length").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    tiles = (
        reps.join(sizes, ["label", "length"])
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select(
            "rep", "copies", "embedding", "block",
            (F.col("low") != F.col("high")).alias("two_blocks"),
            F.xxhash64("label", "length", "low", "high").alias("g"),
        )
    )
    found = each_group(tiles, "g", _tiles(cosine), "a long, b long, links long", "rep")
    found = stored(found, "links")

    links = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    members = good.join(reps, same).select("vec_id", "rep", "copies")
    own = members.where("copies > 1").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    roots = components(found.where("links = 0").select("a", "b").union(own), "vector-classes")
    counted = members.join(links, "rep", "left").groupBy("vec_id").agg(
        F.max(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n")
    )
    at = rows.select("vec_id").join(counted, "vec_id", "left")
    at = at.join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    root = F.coalesce("root", "vec_id")
    return at.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(F.col("vec_id") == root, F.lit(True)).alias("kept"),
    )
