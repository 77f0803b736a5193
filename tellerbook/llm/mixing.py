"""Mixing sources to target weights with Sainte-Lague apportionment, in SQL functions only.

The mix is bought in blocks of equal token counts. Sources get integer numbers of
blocks by highest quotients (votes / (2 * seats + 1)), each source's blocks are
apportioned to its shards in the same way, and each shard takes its quota: whole
passes over the shard, then blocks spread evenly from a seeded offset over
documents in seeded order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerbook.llm.store import need_columns, stored
from tellerbook.llm.words import WORD

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 64
SHARD_DOCUMENTS = 512
MOST_SHARDS = 4096


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(seed: int, *columns: str, part: int = 1) -> Column:
    """A non-negative long from a hash of the seed and the columns' text; each hash has parts 1 and 16."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, part, 15), 16, 10).cast("long")


def apportion(parties: DataFrame, group: Sequence[str], name: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Lague: adds ``quota``, the seats of each party within its group.

    ``seats`` is the group's number of seats, ``votes`` a party's weight; ties of
    quotients go to the smaller ``name``, null last. Multiplying votes by a common
    factor and rounding gives almost all seats at once; only the last few of each
    party are ranked by quotient, at most four per party on average. A group
    without votes gets no seats.
    """
    of = Window.partitionBy(*group)
    total, n = F.sum(votes).over(of), F.count("*").over(of)
    base = parties.withColumn("_v", total).withColumn("_n", n)
    low = F.greatest(F.lit(0.0), F.floor(F.col(votes) * (F.col(seats) - F.col("_n") / 2) / F.col("_v") + 0.5) - 1)
    high = F.floor(F.col(votes) * (F.col(seats) + F.col("_n") / 2) / F.col("_v") + 0.5) + 1
    base = base.where("_v > 0").withColumn("_low", low.cast("long")).withColumn("_high", high.cast("long"))
    base = base.withColumn("_left", F.col(seats) - F.sum("_low").over(of))
    chances = base.withColumn("_s", F.explode(F.expr("sequence(_low, greatest(_low, _high))")))
    quotient = F.col(votes) / (2 * F.col("_s") + 1)
    by = Window.partitionBy(*group).orderBy(quotient.desc(), F.col(name).asc_nulls_last(), "_s")
    ranked = chances.withColumn("_won", F.when(F.row_number().over(by) <= F.col("_left"), 1).otherwise(0))
    return ranked.groupBy(*parties.columns).agg((F.min("_low") + F.sum("_won")).alias("quota"))


def _targets(sources: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """Water-filling: targets in proportion to weights, none above cap times its size."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place - 1) % len(weights) + 1)
    rows = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(cap))
    by = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(share)
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    rows = rows.withColumn("level", level)
    free = F.when(F.col("most") / F.col("weight") > F.col("level"), F.col("level"))
    rows = rows.withColumn("level", F.max(free).over(every))  # the first free row's, by order
    target = F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return rows.select("source", "source_size", "documents", target.alias("target"))


def mix_plan(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, size, source_size, target, taken and where the words lie: the
    document's first word in its shard (``start``), whole passes, and the numbers
    that tell which blocks of the last pass are taken (``blocks``, ``picks``,
    ``turn``). The total is ``share`` times all words; a source's target stops at
    ``cap`` times its size, the excess goes to the others by weight. A source of a
    null name comes last; a null or empty text has size 0 and is never taken.
    Repeated rows are documents of their own, null ids are allowed, further columns
    play no part. No words at all: targets and taken are 0. Texts are counted whole,
    whatever their length; an empty table gives an empty plan.
    """
    rows = need_columns(documents, "doc_id", "source", "text")
    sized = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count("text").alias("size"))
    rows = stored(sized, "sizes")
    return _plan(rows, weights, share, cap, block, seed).drop("row")


def _plan(rows: DataFrame, weights: Sequence[int], share: float, cap: float, block: int, seed: int) -> DataFrame:
    """``mix_plan`` of (doc_id, source, size, row); documents without an id are dealt by their row."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    shards = F.least(F.lit(MOST_SHARDS), F.ceil(F.col("documents") / SHARD_DOCUMENTS))
    sources = _targets(sources, weights, share, cap).withColumn("shards", shards.cast("long"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumn("seats", F.round(F.sum("target").over(everything) / block).cast("long"))
    quotas = apportion(sources, [], "source", "target", "seats")
    sources = stored(
        sources.join(quotas.select(F.col("source").alias("_s"), "quota"), F.col("source").eqNullSafe(F.col("_s")), "left")
        .drop("_s", "seats").withColumn("quota", F.coalesce("quota", F.lit(0))),
        "sources",
    )

    named = sources.withColumnRenamed("source", "_s")
    dealt = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("\0"), F.col("row")))
    placed = (
        rows.join(named, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("_d", dealt)
        .withColumn("_h", seeded(seed, "_d"))
        .withColumn("shard", F.pmod(seeded(seed, "_d", part=16), "shards"))
        .select("row", "doc_id", "source", "size", "source_size", "target", "quota", "_h", "shard")
    )
    lots = placed.groupBy("source", "shard", F.col("quota").alias("seats")).agg(F.sum("size").alias("words"))
    lots = apportion(lots, ["source"], "shard", "words", "seats")
    lots = lots.select(F.col("source").alias("_s"), F.col("shard").alias("_k"), "words", F.col("quota").alias("lot"))
    up_to = Window.partitionBy("source", "shard").orderBy("_h", "doc_id", "size", "row")
    end = F.sum("size").over(up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("start", end - F.col("size"))
    at = placed.join(lots, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_k")), "left")

    due = F.least(F.coalesce(F.col("lot") * block, F.lit(0)).cast("double"), F.col("words") * F.lit(cap)).cast("long")
    at = at.withColumn("passes", F.when(F.col("words") > 0, F.floor(due / F.col("words"))).otherwise(0).cast("long"))
    rest = F.when(F.col("words") > 0, due - F.col("passes") * F.col("words")).otherwise(0)
    at = (
        at.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("words") / block)).cast("long"))
        .withColumn("picks", F.least("blocks", F.round(rest / block)).cast("long"))
        .withColumn("turn", F.pmod(seeded(seed, "source", "shard"), "blocks"))
    )
    taken = F.col("passes") * F.col("size") + (words_before("start + size", block) - words_before("start", block))
    return at.select(
        "row", "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
        "shard", "start", "passes", "blocks", "picks", "turn",
    )


def picked_before(j: str) -> str:
    """How many of the blocks before block j are taken (up to a constant)."""
    return f"(({j} + turn) * picks) div blocks"


def words_before(position: str, block: int) -> Column:
    """Words taken in the last pass before a position of the shard (up to a constant)."""
    j = f"(({position}) div {block})"
    return F.expr(
        f"{block} * ({picked_before(j)}) + (({position}) % {block}) * "
        f"(({picked_before(f'({j} + 1)')}) - ({picked_before(j)}))"
    )


def mixed(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """The mix itself: rows with the columns of ``documents`` and the words taken.

    A document taken whole comes once per pass; of the last pass it keeps the
    words in the blocks taken, each with the white space behind it. ``n_chars``, if
    there is one, counts the new text. Documents of which nothing is taken go, so null,
    empty and blank texts do. Repeated rows and null ids are rows of their own; an
    empty table stays empty; texts of any length are cut whole.

    Rows are written once and their numbers join them with the plan, one to one.
    """
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count("text").alias("size"),
        F.struct(*documents.columns).alias("_row"),
    )
    rows = stored(rows, "mixed")
    plan = _plan(rows.select("row", "doc_id", "source", "size"), weights, share, cap, block, seed)
    plan = plan.where("taken > 0").select(
        "row", F.col("size").alias("_size"), "taken", "start", "passes", "blocks", "picks", "turn"
    )
    both = rows.select("row", "size", "_row", F.col("_row.text").alias("text")).join(plan, "row")
    rest = F.col("taken") - F.col("passes") * F.col("_size")
    words = F.regexp_extract_all("text", F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    taken = F.expr(
        f"""concat_ws('', filter(_words, (w, i) ->
            (((start + i) div {block} + 1 + turn) * picks) div blocks
            > (((start + i) div {block} + turn) * picks) div blocks))"""
    )
    partly = F.when(rest == 0, F.array()).when(rest == F.col("size"), F.array("text")).otherwise(F.array(taken))
    copies = F.concat(F.array_repeat("text", F.col("passes").cast("int")), partly)
    out = both.withColumn("_words", F.when((rest > 0) & (rest < F.col("size")), words))
    out = out.withColumn("_text", F.explode(copies))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast(_kind(documents, "n_chars"))}
    return out.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in documents.columns])


def _kind(rows: DataFrame, name: str) -> str:
    return dict(rows.dtypes).get(name, "long")
