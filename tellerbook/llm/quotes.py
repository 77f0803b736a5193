"""Quotation linking: conversations in reply order, without quotes, in SQL functions only.

A line's quote level is the number of its leading ``>`` marks. Neighbouring lines of
a level form a passage; passages and their lines are normalised and hashed. A quoted
hash is joined to the latest earlier message of the conversation that has it in
words of its own. That is the message quoted; the nearest level decides what a
message answers. Without any such link it answers the turn before.

A conversation and a passage may have any number of messages: joins and ranks go by
stretches of ``STRETCH`` turns, and only one number per stretch crosses them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerbook.llm.pii import let
from tellerbook.llm.store import need_columns, stored

STRETCH = 256
MARKS = r"^((?:[ \t]*>)+)"
#: Lines that announce a quote, in four languages (fixed patterns).
ANNOUNCED = (
    r"(?i)^[ \t]*(?:on\b.*\bwrote|am\b.*\bschrieb\b.*|le\b.*\ba écrit|el\b.*\bescribió)[ \t]*:[ \t]*$"
)


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def _with_passages(rows: DataFrame) -> DataFrame:
    """Adds ``lines`` (level, normalised text) and ``units`` (level, text): passages and single lines."""
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda x: F.struct(_level(x).alias("level"), _normal(F.regexp_replace(x, MARKS, "")).alias("text")),
    )
    rows = rows.withColumn("lines", lines)

    def begins(i: Column) -> Column:
        here, before = F.element_at("lines", i), F.element_at("lines", i - 1)
        return F.when(i == 1, True).otherwise(
            (here["level"] != before["level"]) | (here["text"] == "") | (before["text"] == "")
        )

    starts = F.filter(F.transform(F.sequence(F.lit(1), F.size("lines")), lambda i: i.cast("int")), begins)
    rows = rows.withColumn("starts", starts)

    def passage(s: Column, k: Column) -> Column:
        after = F.coalesce(F.get("starts", k + 1), F.size("lines") + 1)
        own = F.slice("lines", s, after - s)
        words = F.array_join(F.transform(own, lambda x: x["text"]), " ")
        return F.struct(F.element_at("lines", s)["level"].alias("level"), words.alias("text"))

    rows = rows.withColumn("units", F.transform("starts", passage))
    units = F.filter(F.array_distinct(F.concat("units", "lines")), lambda x: x["text"] != "")
    return rows.withColumn("units", units).drop("starts", "lines")


def without_quotes(text: Column) -> Column:
    """The lines of level 0, without announcements of quotes and blank lines at the end."""

    def kept_of(lines: Column) -> Column:
        def own(x: Column, i: Column) -> Column:
            below = F.coalesce(F.get(lines, i + 1), F.lit(""))
            announces = x.rlike(ANNOUNCED) & below.rlike(r"^[ \t]*(?:>.*)?$")
            return ~x.rlike(MARKS) & ~announces

        return F.filter(lines, own)

    kept = let(F.split(text, "\n", -1), kept_of)
    kept = F.regexp_replace(F.array_join(kept, "\n"), r"\s+\z", "")
    return F.when(text.rlike(r"(?m)" + MARKS), kept).otherwise(text)


def _latest_before(asked: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Adds to ``asked`` the greatest ``turn`` of ``events`` with equal keys below its own.

    Stretches of turns keep a key of any number of rows from meeting in one task.
    """
    stretch = F.floor(F.col("turn") / STRETCH).alias("stretch")
    points = events.select(*keys, "turn", stretch).distinct()
    tops = points.groupBy(*keys, "stretch").agg(F.max("turn").alias("top"))
    asked = asked.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    # One row for each stretch that has events or questions, with the last event before it.
    known = tops.unionByName(
        asked.select(*keys, "stretch").distinct().withColumn("top", F.lit(None).cast("long"))
    )
    known = known.groupBy(*keys, "stretch").agg(F.max("top").alias("top"))
    past = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("earlier", F.max("top").over(past)).drop("top")
    both = asked.select(*keys, "stretch", "turn").distinct().withColumn("event", F.lit(None).cast("long")).unionByName(
        points.withColumn("event", F.col("turn"))
    )
    inside = Window.partitionBy(*keys, "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("within", F.max("event").over(inside)).where("event IS NULL").drop("event")
    found = found.join(known, [*keys, "stretch"]).select(*keys, "turn", F.coalesce("within", "earlier").alias("before"))
    return asked.drop("stretch").join(found, [*keys, "turn"], "left")


def quote_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, source): which earlier turn each quoted level of a message comes from.

    Rows of equal conv_id and turn are parts of one message.
    """
    rows = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL")
    quoting = rows.where(F.col("text").rlike(r"(?m)" + MARKS))
    # An outer explode: Spark derives a filter from an inner one and would cut up all texts to apply it.
    units = _with_passages(quoting).select("conv_id", "turn", F.explode_outer("units").alias("unit"))
    units = units.select("conv_id", "turn", F.col("unit.level").alias("level"), F.xxhash64("unit.text").alias("hash"))
    quoted = stored(units.where("level > 0").distinct(), "quoted")
    # Only conversations with quotes, and of these only passages that are quoted.
    own = rows.join(quoted.select("conv_id").distinct(), "conv_id", "left_semi")
    own = _with_passages(own).select("conv_id", "turn", F.explode_outer("units").alias("unit"))
    own = own.where("unit.level = 0").select("conv_id", "turn", F.xxhash64("unit.text").alias("hash"))
    own = own.join(quoted.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    own = stored(own, "quoted-from")
    linked = _latest_before(quoted, own, ["conv_id", "hash"]).where("before IS NOT NULL")
    return linked.groupBy("conv_id", "turn", "level").agg(F.max("before").alias("source"))


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """Messages without quotes, numbered so that no reply stands before what it answers.

    Returns conv_id, position (from 0), turn, role, text, reply_to (a turn, null for
    the first), quoted (turns quoted, by level) and formatted. The order is that of
    turns, which replies follow; equal turns are parts of one message, go by role and
    text, and share their links. Null conv_id or
    turn: the message comes out without position or links. A null text stays null, an
    empty one empty; texts of any length are cut up whole. Repeated rows come out as
    often; further columns play no part; an empty table stays empty.
    """
    rows = need_columns(conversations, "conv_id", "turn", "role", "text")
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    links = stored(quote_links(rows), "quote-links")
    best = links.groupBy("conv_id", "turn").agg(
        F.min_by("source", "level").alias("source"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("level", "source")))).alias("quoted"),
    )

    placed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    turns = placed.groupBy("conv_id", "turn").agg(F.count("*").alias("n"))
    turns = turns.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.groupBy("conv_id", "stretch").agg(F.sum("n").alias("n"), F.max("turn").alias("top"))
    sums = sums.select(
        "conv_id", "stretch",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.max("top").over(before).alias("earlier"),
    )
    inside = Window.partitionBy("conv_id", "stretch").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    turns = turns.withColumn("last", F.max("turn").over(inside)).drop("n").join(sums, ["conv_id", "stretch"])
    turns = turns.select(
        "conv_id", "turn", (F.col("first") + F.col("within")).alias("first"),
        F.coalesce("last", "earlier").alias("previous"),
    )
    turns = turns.join(best, ["conv_id", "turn"], "left")

    equal = Window.partitionBy("conv_id", "turn").orderBy(F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last())
    out = placed.withColumn("_i", F.row_number().over(equal) - 1).join(turns, ["conv_id", "turn"])
    out = out.select(
        "conv_id", (F.col("first") + F.col("_i")).alias("position"), "turn", "role",
        without_quotes(F.col("text")).alias("text"), F.coalesce("source", "previous").alias("reply_to"), "quoted",
    )
    lost = rows.where("conv_id IS NULL OR turn IS NULL").select(
        "conv_id", F.lit(None).cast("long").alias("position"), "turn", "role", without_quotes(F.col("text")).alias("text"),
        F.lit(None).cast("long").alias("reply_to"), F.lit(None).cast("map<int,bigint>").alias("quoted"),
    )
    name, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return out.union(lost).withColumn("formatted", F.concat(F.lit("<|"), name, F.lit("|>\n"), text, F.lit("\n")))
