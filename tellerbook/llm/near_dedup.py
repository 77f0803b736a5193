"""Near-duplicate documents: an LSH forest over MinHash signatures.

Every distinct shingle set gets a signature of 128 minima. The forest keeps several
orders of it; an order reads the signature's values in a sequence of its own, and sets
whose sequences begin alike stand next to each other in it. A region is what has a
common prefix of some depth in an order. It begins at four values. Where a region holds
more sets than one task compares (``TASK``), its sets go on to the next depth of
``DEPTHS``, in as many orders as keep the chance to part a pair at the threshold
below ``MISS`` there. So the depth follows the region: a pair is compared at the first
depth at which one of the regions that it shares is small enough, or in the deepest
regions, which are compared whole in blocks of ``BLOCK`` sets, whatever their size.

Many sets in one region are mostly near copies of each other. So the sets of regions of more
than ``BLOCK`` are first held against a few pivots drawn from these, whole set against whole set;
what pivots link is one class, and only sets of different classes are compared
from there on. Where a region is larger than a task, its largest class meets only the sets outside
it, and a region of one class needs no comparison at all.

The texts of all documents are moved once, to keep those whose sets share a region.

Members of a region are compared by signature, and pairs that may reach the threshold
by their whole sets. In a region the sets are sorted by size, and a set meets only
those whose size lets the two reach the threshold.

A pair at a similarity of 0.85 shares four values of an order with
probability 0.52; ``miss`` gives the chance that it does so in none, and meets the
noise of the signature too. The
signature filter lies five standard deviations below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerbook.llm.graph import Forest, components
from tellerbook.llm.groups import each_group
from tellerbook.llm.store import few_tasks, need_columns, stored
from tellerbook.llm.words import mix, shingle_sets

SIZE = 128
#: Orders at the first depth, and the least at any.
ORDERS = 20
#: Values of the common prefix of a region.
DEPTHS = (4, 5, 6, 8, 10, 12)
#: Sets that one task compares, all with all.
TASK = 1024
#: At a further depth a pair at the threshold is in no common region with at most this probability.
MISS = 4e-4
#: Depths that need more orders than this are not used.
MOST_ORDERS = 160
BLOCK = 256
#: Of the pivots of its crowded regions a set meets so many by signature, and of these so many by whole sets.
MET, LIKEST = 8, 3

_MULTIPLIERS = (mix(np.arange(1, SIZE + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (mix(np.arange(9001, 9001 + SIZE, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_PREFIX = mix(np.arange(5001, 5001 + DEPTHS[-1], dtype=np.uint64)) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each of the 128 hash functions over a non-empty set."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SIZE, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(short), 2048):
        part = short[None, a : a + 2048] * _MULTIPLIERS[:, None] + _SHIFTS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


@lru_cache(maxsize=1024)
def sequence(order: int) -> np.ndarray:
    """The places of the signature that an order reads; the first orders begin with places of their own."""
    drawn = np.argsort(mix(np.arange(SIZE, dtype=np.uint64) + np.uint64((order + 1) << 20)))
    own = SIZE // ORDERS
    if order >= ORDERS:
        return drawn[: DEPTHS[-1]]
    first = np.arange(order * own, (order + 1) * own)
    return np.concatenate([first, drawn[~np.isin(drawn, first)]])[: DEPTHS[-1]]


def prefixes(signatures: np.ndarray, depth: int, orders: int) -> np.ndarray:
    """Per signature and order, a hash of the first values that the order reads."""
    total = np.arange(1, orders + 1, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    total = np.repeat(total, len(signatures), axis=0)
    places = np.array([sequence(t)[:depth] for t in range(orders)]).reshape(orders, depth)
    for k in range(depth):
        total = total + signatures[:, places[:, k]].astype(np.uint64) * _PREFIX[k]
    return mix(total)


def miss(depth: int, orders: int, similarity: int) -> float:
    """The chance that a pair at the threshold shares no region of a depth.

    Its signatures agree in a binomial number of places; given that, each order's places
    are a draw of ``depth`` among all.
    """
    share, total = similarity / 100, 0.0
    for equal in range(SIZE + 1):
        weight = comb(SIZE, equal) * share**equal * (1 - share) ** (SIZE - equal)
        total += weight * (1 - comb(equal, depth) / comb(SIZE, depth)) ** orders
    return total


@lru_cache(maxsize=256)
def orders_at(depth: int, similarity: int) -> int:
    """How many orders a depth needs, so that ``MISS`` holds."""
    return next((k for k in range(ORDERS, MOST_ORDERS + 1) if miss(depth, k, similarity) <= MISS), MOST_ORDERS + 1)


def depths_for(similarity: int) -> list[int]:
    """The first depth, and the further ones for which ``MOST_ORDERS`` are enough."""
    return [d for d in DEPTHS if d == DEPTHS[0] or orders_at(d, similarity) <= MOST_ORDERS]


def _listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    flat = pa.array(values.reshape(-1), kind)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), flat)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        sizes, one, two = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        signs = np.zeros((n, SIZE), np.uint16)
        for i, own in enumerate(shingle_sets(batch.column(1))):
            sizes[i] = len(own)
            if len(own):
                one[i] = own.sum(dtype=np.uint64)
                two[i] = mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                signs[i] = signature(own).astype(np.uint16)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "n_shingles": sizes,
                "d1": one.view(np.int64),
                "d2": two.view(np.int64),
                "sign": pa.array([s.tobytes() for s in signs], pa.binary()),
                "keys": _listed(prefixes(signs, DEPTHS[0], ORDERS).view(np.int64), pa.int64()),
            }
        )


def _signs(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), SIZE)


def _deeper(depth: int, orders: int, before: int):
    """(doc_id, d1, sign, open) to the keys of their regions at a depth, by order.

    Of the ``before`` orders of the last depth only those in ``open`` go on: a region
    lies in that of the same order there, and if it was compared, so were its parts.
    """

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = prefixes(_signs(batch.column(2)), depth, orders)
                goes = np.ones(keys.shape, bool)
                goes[:, :before] = False
                for own, thick in zip(goes, batch.column(3).to_pylist(), strict=True):
                    own[thick] = True
                at, t = np.nonzero(goes)
                taken = pa.array(at)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column(0).take(taken), "d1": batch.column(1).take(taken), "t": pa.array(t, pa.int32()), "key": keys[at, t].view(np.int64)}
                )

    return function


def _ship_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column(1)))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "d1": np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
                "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
            }
        )


def _least(similarity: int) -> float:
    """Equal values of two signatures that may reach the threshold: five deviations below it."""
    share = similarity / 100
    return SIZE * share - 5 * np.sqrt(SIZE * share * (1 - share))


def _similar(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    both = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * both >= similarity * (len(x) + len(y) - both)


def _near_pivots(similarity: int):
    """Pairs of a set and a pivot that may reach the threshold, with their equal values."""

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = (_signs(batch.column("sign")) == _signs(batch.column("pivot_sign"))).sum(axis=1)
                rows = batch.select(["doc_id", "d1", "pivot", "pivot_d1"]).append_column("equal", pa.array(equal, pa.int64()))
                yield rows.filter(pa.array(equal >= _least(similarity)))

    return function


def _pivot_links(similarity: int):
    """The pairs of a set and a pivot that reach the threshold."""

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = ([np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column(c)] for c in ("shingles", "pivot_shingles"))
            linked = [_similar(x, y, similarity) for x, y in zip(one, two, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("pivot")], ["a", "b"]).filter(
                pa.array(linked, pa.bool_())
            )

    return function


class _Region:
    """The members of one region, or of two of its blocks."""

    def __init__(self, rows: pa.Table, similarity: int):
        n = rows.num_rows
        self.n, self.ids = n, rows.column("doc_id").to_numpy()
        self.classes = rows.column("class").to_numpy()
        self.sizes = rows.column("n_shingles").to_numpy()
        self.signs = _signs(rows.column("sign"))
        # The regions of earlier orders at this depth, to leave out pairs that meet there;
        # not those that go on to the next depth, where pairs may part.
        order, depth = (rows.column(c)[0].as_py() for c in ("t", "depth"))
        self.earlier = prefixes(self.signs, depth, order) if order else None
        for i, thick in enumerate(rows.column("open").to_pylist() if order else []):
            self.earlier[i, [t for t in thick if t < order]] ^= np.uint64(i + 1)
        self.block = rows.column("block").to_numpy()
        self.two = rows.column("two_blocks")[0].as_py()
        self.share = similarity / 100
        self.least = _least(similarity)

    def pairs(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(i, partners j > i, equal values) that no earlier order shows and that may reach the threshold."""
        # Sorted by size: the sets that may be similar to one end where sizes grow too large.
        ends = np.searchsorted(self.sizes, self.sizes / self.share + 1e-9, side="right")
        for i in range(self.n - 1):
            rest = slice(i + 1, ends[i])
            if rest.start >= rest.stop:
                continue
            open_ = self.classes[rest] != self.classes[i]
            if self.earlier is not None:
                open_ &= ~(self.earlier[rest] == self.earlier[i]).any(axis=1)
            if self.two:
                open_ &= self.block[rest] != self.block[i]
            j = np.flatnonzero(open_) + i + 1
            if len(j):
                equal = (self.signs[j] == self.signs[i]).sum(axis=1)
                keep = equal >= self.least
                if keep.any():
                    yield i, j[keep], equal[keep]


def _wanted(similarity: int):
    def function(rows: pa.Table) -> Iterator[dict]:
        if rows.num_rows > 1:
            region = _Region(rows, similarity)
            seen = np.zeros(region.n, bool)
            for i, j, _ in region.pairs():
                seen[i], seen[j] = True, True
            if seen.any():
                yield {
                    "doc_id": region.ids[seen],
                    "d1": rows.column("d1").to_numpy()[seen],
                    "g": rows.column("g").to_numpy()[seen],
                }

    return function


def _links(similarity: int):
    def function(rows: pa.Table) -> Iterator[dict]:
        region = _Region(rows, similarity)
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("shingles")]
        found = [(e, i, j) for i, js, equal in region.pairs() for j, e in zip(js.tolist(), equal.tolist(), strict=True)]
        found.sort(reverse=True)
        trees, a, b = Forest(region.n), [], []
        for _, i, j in found:
            if trees.find(i) != trees.find(j):
                if _similar(sets[i], sets[j], similarity):
                    trees.join(i, j)
                    a.append(region.ids[i])
                    b.append(region.ids[j])
        if a:
            yield {"a": np.array(a), "b": np.array(b)}

    return function


def _regions(keys: DataFrame, depth: int) -> DataFrame:
    """(doc_id, d1, t, key, members) of the regions of two members or more at a depth."""
    counts = keys.groupBy("t", "key").agg(F.count("*").alias("members")).where("members > 1")
    return stored(keys.join(counts, ["t", "key"]), f"regions-{depth}")


def _texts(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of these ids."""
    # The same kind of join at every size; the ids are too many to broadcast in general.
    return rows.join(ids.distinct().hint("merge"), "doc_id")


def _sets(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, d1, shingles) of the texts of these ids."""
    sets = few_tasks(_texts(rows, ids)).mapInArrow(_ship_sets, "doc_id long, d1 long, shingles binary")
    return sets.groupBy("doc_id", "d1").agg(F.max("shingles").alias("shingles"))


def _classed(rows: DataFrame, classes: DataFrame | None) -> DataFrame:
    """Rows with the class of their set among ``classes`` (node, root); others are their own."""
    if classes is None:
        return rows.withColumn("class", F.col("doc_id"))
    known = classes.withColumnRenamed("node", "doc_id")
    return rows.join(known, "doc_id", "left").withColumn("class", F.coalesce("root", "doc_id")).drop("root")


def _most(column: str, n: int) -> Column:
    """The ``n`` largest structs of an array, as rows."""
    return F.inline(F.slice(F.sort_array(column, asc=False), 1, n))


def _pivoted(regions: DataFrame, heads: DataFrame, texts: DataFrame, similarity: int) -> DataFrame | None:
    """(a, b): links of the sets of crowded regions with pivots, confirmed on the whole sets.

    Each region draws two pivots, one as all regions do, so that those of one crowd agree, and
    one of its own. A set meets those that most of its regions have drawn. This only saves
    comparisons: sets of different classes are compared in their regions all the same.
    """
    crowded, own = regions.where(F.col("members") > BLOCK).select("doc_id", "d1", "t", "key"), ["doc_id", "d1"]
    if crowded.isEmpty():
        return None
    signs = stored(heads.join(crowded.select(*own).distinct(), own).select(*own, "sign"), "signs")
    as_pivot = {"doc_id": "pivot", "d1": "pivot_d1", "sign": "pivot_sign", "shingles": "pivot_shingles"}
    pivot = F.struct(F.col("doc_id").alias("pivot"), F.col("d1").alias("pivot_d1"))
    draws = [F.min_by(pivot, F.xxhash64(*own, salt)) for salt in (F.lit(-1), F.col("t"))]
    pivots = crowded.groupBy("t", "key").agg(F.array_distinct(F.array(*draws)).alias("pivots"))
    # Of a set's regions there are as many as orders.
    drawn = F.flatten(F.collect_list("pivots")).alias("drawn")
    met = crowded.join(pivots, ["t", "key"]).groupBy(*own).agg(drawn)
    shared = F.transform(
        F.filter(F.array_distinct("drawn"), lambda p: p["pivot"] != F.col("doc_id")),
        lambda p: F.struct(F.size(F.filter("drawn", lambda q: q == p)).alias("shared"), p["pivot"].alias("pivot"), p["pivot_d1"].alias("pivot_d1")),
    )
    met = met.select(*own, shared.alias("met")).select(*own, _most("met", MET)).drop("shared")
    near = met.join(signs, own).join(signs.withColumnsRenamed(as_pivot), ["pivot", "pivot_d1"])
    near = few_tasks(near).mapInArrow(_near_pivots(similarity), "doc_id long, d1 long, pivot long, pivot_d1 long, equal long")
    near = near.groupBy(*own).agg(F.collect_list(F.struct("equal", "pivot", "pivot_d1")).alias("near"))
    near = stored(near.select(*own, _most("near", LIKEST)), "near-pivots")
    sets = _sets(texts, near.select("doc_id").union(near.select("pivot")))
    whole = near.join(sets, own).join(sets.withColumnsRenamed(as_pivot), ["pivot", "pivot_d1"])
    whole = few_tasks(whole.select("doc_id", "pivot", "shingles", "pivot_shingles"))
    return whole.mapInArrow(_pivot_links(similarity), "a long, b long")


def _first_regions(heads: DataFrame) -> DataFrame:
    return _regions(heads.select("doc_id", "d1", F.posexplode("keys").alias("t", "key")), DEPTHS[0])


def _forest(
    heads: DataFrame, similarity: int, first: DataFrame | None = None, classes: DataFrame | None = None
) -> DataFrame:
    """(doc_id, d1, class, t, depth, open, block, two_blocks, g): which sets are compared with each other in which task.

    ``first`` has the regions of the first depth, ``classes`` (node, root) what is known to be linked.
    Regions that one task can hold are groups of their own, and so are those of a large class
    and few others; the sets of other ones go on to the next depth. What is larger than a task
    is cut into blocks, every two of which are a group; of the largest class no two blocks
    meet. Such regions of one class are left out.
    """
    regions, found = _first_regions(heads) if first is None else first, None
    depths = depths_for(similarity)
    for place, depth in enumerate(depths):
        last = place + 1 == len(depths)
        none = regions.where(F.col("members") > TASK).isEmpty()
        regions = _classed(regions, classes).withColumn("depth", F.lit(depth))
        small, wide = regions.where(F.col("members") <= TASK), regions.where(F.col("members") > TASK)
        regions = small.withColumn("largest", F.lit(0).cast("long")).withColumn("top", F.lit(None).cast("long"))
        if not none and classes is None:
            regions = regions.unionByName(wide.withColumn("largest", F.lit(0).cast("long")).withColumn("top", F.lit(None).cast("long")))
        elif not none:
            counts = wide.groupBy("t", "key", "class").agg(F.count("*").alias("n"))
            counts = counts.groupBy("t", "key").agg(F.max(F.struct("n", "class")).alias("_top"), F.count("*").alias("kinds"))
            counts = counts.where("kinds > 1").select("t", "key", F.col("_top.n").alias("largest"), F.col("_top.class").alias("top"))
            regions = stored(regions.unionByName(wide.join(counts, ["t", "key"])), f"classed-{depth}")
        few = (F.col("members") <= TASK) | (F.col("members") - F.col("largest") <= min(BLOCK, TASK))
        thick = None if last or none else regions.where(~few)
        thick = None if thick is None or thick.isEmpty() else thick.groupBy("doc_id", "d1").agg(F.collect_list("t").alias("open"))
        if thick is None:
            fits = regions.withColumn("open", F.array().cast("array<int>"))
        else:
            own = Window.partitionBy("doc_id", "d1")
            fits = regions.withColumn("open", F.collect_list(F.when(~few, F.col("t"))).over(own)).where(few)
        cut, in_top = F.col("members") > TASK, F.col("class").eqNullSafe(F.col("top"))
        # Blocks of the largest class come first, those of all others behind them.
        tops = F.when(cut & F.col("top").isNotNull(), F.ceil(F.col("largest") / BLOCK)).otherwise(0)
        rest = F.when(F.col("top").isNotNull(), F.col("members") - F.col("largest")).otherwise(F.col("members"))
        dealt = F.xxhash64("doc_id")
        groups = (
            fits.withColumn("tops", tops.cast("int"))
            .withColumn("rests", F.when(cut, F.ceil(rest / BLOCK)).otherwise(1).cast("int"))
            .withColumn(
                "block",
                F.when(cut & in_top, F.pmod(dealt, F.greatest("tops", F.lit(1)))).otherwise(F.col("tops") + F.pmod(dealt, F.col("rests"))).cast("int"),
            )
            .withColumn("other", F.explode(F.sequence(F.when(cut & in_top, F.col("tops")).otherwise(0), F.col("tops") + F.col("rests") - 1)))
            .withColumn("low", F.least("block", "other"))
            .withColumn("high", F.greatest("block", "other"))
            .select(
                "doc_id", "d1", "class", "t", "depth", "open", "block",
                (F.col("low") != F.col("high")).alias("two_blocks"),
                F.xxhash64("depth", "t", "key", "low", "high").alias("g"),
            )
        )
        found = groups if found is None else found.union(groups)
        if thick is None:
            return found
        deeper = depths[place + 1]
        crowd = heads.join(thick, ["doc_id", "d1"]).select("doc_id", "d1", "sign", "open")
        before = orders_at(depth, similarity) if place else ORDERS
        deep = _deeper(deeper, orders_at(deeper, similarity), before)
        # Keys are read twice, to count them and to join the counts.
        keys = stored(few_tasks(crowd).mapInArrow(deep, "doc_id long, d1 long, t int, key long"), f"keys-{deeper}")
        regions = _regions(keys, deeper)
    raise AssertionError("no depths")


def near_duplicates(documents: DataFrame, similarity: int = 80) -> DataFrame:
    """Classes of documents linked by 100 * intersection >= similarity * union of shingle sets.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable over
    links) and kept. Equal sets are compared once and linked through their smallest
    doc_id, so copies cost nothing. A null or empty text, or one without words, has
    no shingles and is a class of its own. A null doc_id is linked with nothing.
    Repeated rows of a doc_id come out once each; their sets all count. Further
    columns of ``documents`` play no part; texts of any length are read whole; an empty
    table stays empty.
    """
    rows = need_columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    kinds = "doc_id long, n_shingles long, d1 long, d2 long, sign binary, keys array<long>"
    sketches = stored(rows.mapInArrow(_sketches, kinds), "sketches")

    same = ["n_shingles", "d1", "d2"]
    full = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = full.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    copies = full.join(reps, same).where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # Equal sets have equal signatures.
    one = full.groupBy(*same).agg(F.min("doc_id").alias("doc_id"), F.first("sign").alias("sign"), F.first("keys").alias("keys"))
    heads = stored(one.select("doc_id", "d1", "n_shingles", "sign", "keys"), "heads")
    own = ["doc_id", "d1"]
    first = _first_regions(heads)
    # All texts are moved here, and only here.
    texts = stored(_texts(rows, first.select("doc_id")), "texts")
    pivot_links = _pivoted(first, heads, texts, similarity)
    classes = None if pivot_links is None else stored(components(pivot_links, "pivot-classes"), "classes")
    dealt = stored(_forest(heads, similarity, first, classes), "dealt")
    # Most sets share no region: from here on only those that do are moved.
    heads = heads.select("doc_id", "d1", "n_shingles", "sign")
    heads = stored(heads.join(dealt.select(*own).distinct(), own), "crowd")
    members = dealt.join(heads, own)
    wanted = each_group(members, "g", _wanted(similarity), "doc_id long, d1 long, g long", "n_shingles", *own)
    wanted = stored(wanted, "wanted")

    sets = _sets(texts, wanted.select("doc_id"))
    whole = dealt.join(wanted, [*own, "g"], "left_semi").join(heads.join(sets, own), own)
    links = each_group(whole, "g", _links(similarity), "a long, b long", "n_shingles", *own)

    links = links.union(copies)
    links = links if classes is None else links.union(classes.select("node", "root"))
    roots = components(links, "near-classes")
    root = F.coalesce("root", "doc_id")
    return (
        sketches.select("doc_id", "n_shingles")
        .join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", root.alias("component_id"), F.coalesce(F.col("doc_id") == root, F.lit(True)).alias("kept"))
    )
