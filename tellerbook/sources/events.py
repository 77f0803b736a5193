"""JSON event lines: encode, write, read as a stream, parse."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.functions.columns import utc_instant
from tellerbook.schemas import EVENT, EVENT_TEXT_FIELDS, EXTRA
from tellerbook.session import limit_methods

# Reasons a line is rejected.
MALFORMED = "malformed"
BAD_AMOUNT = "bad amount"
BAD_TIMESTAMP = "bad timestamp"
BLANK_TYPE = "blank transaction_type"

_MESSAGE = "struct<" + ",".join(f"{name}:string" for name in EVENT.fieldNames()) + ">"


def encode_events(rows: DataFrame) -> DataFrame:
    """One JSON object per row, in a single ``value`` column."""
    return rows.select(
        F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def write_events(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Publish rows as JSON lines; every task writes its own files."""
    encode_events(rows).write.mode(mode).text(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_event_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    max_file_age: str = "1000000d",
) -> DataFrame:
    """JSON lines landing in a folder, at most so many files, or bytes, a trigger.

    Spark skips files older than ``max_file_age`` before the newest one seen. The
    default here is an age that no file can reach, so none is lost.
    """
    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def _decode(line: Column, mark: str) -> Column:
    """One strict JSON object per line, decoded in a single pass.

    The line is parsed inside an envelope, as the only element of a list:
    whatever follows the first object then breaks the envelope or makes the
    list longer, instead of being skipped silently. The envelope ends in a
    mark drawn when the query is built, which a line that closes the envelope
    itself cannot know. Results do not depend on the mark.
    """
    return F.from_json(
        _envelope(line, mark),
        f"struct<messages:array<{_MESSAGE}>,whole:string,broken:string>",
        {"columnNameOfCorruptRecord": "broken", "allowSingleQuotes": "false"},
    )


def _envelope(line: Column, mark: str) -> Column:
    return F.concat(F.lit('{"messages":['), line, F.lit(f'],"whole":"{mark}"}}'))


def _closes_envelope(line: Column, mark: str) -> Column:
    """True for a line that ends the list early; only a line with a bracket can."""
    keys = F.json_object_keys(_envelope(line, mark))
    whole = F.coalesce(keys == F.array(F.lit("messages"), F.lit("whole")), F.lit(False))
    return F.contains(line, F.lit("]")) & ~whole


def _unknown_fields(line: Column) -> Column:
    """The fields of an object that the schema doesn't know, as a VARIANT object; else NULL.

    Only lines with such a field are parsed for them. An object that names a field twice
    has no variant and gives NULL.
    """
    known = F.array(*[F.lit(name) for name in EVENT.fieldNames()])
    there = F.size(F.array_except(F.json_object_keys(line), known)) > 0
    fields = F.try_variant_get(F.try_parse_json(line), "$", "map<string,variant>")
    unknown = F.map_filter(fields, lambda name, _: ~name.isin(*EVENT.fieldNames()))
    return F.when(there, F.to_variant_object(unknown))


def _number(text: Column) -> Column:
    """Text as a number; the suffixes d and f of other languages make it none."""
    return F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))


def _finite(number: Column) -> Column:
    """The number, or NULL for NaN and the infinities."""
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def parse_events(
    lines: DataFrame, missing_text: str | None = None, keep_unknown: bool = False
) -> DataFrame:
    """Event columns plus ``value`` and ``reason``; no line is dropped.

    ``reason`` is NULL on accepted rows, and ``value`` is kept only on
    rejected ones. An absent amount is 0.0. With ``missing_text`` set, absent
    text fields get that text and timestamps are not checked, so only lines
    that cannot be decoded or have no usable amount are rejected. ``keep_unknown``
    adds ``extra``, a VARIANT object of the accepted line's other fields. Parsing and what
    follows it in a stage are more code than the JVM compiles in one method, so the
    session gets a limit (see ``limit_methods``).
    """
    limit_methods(lines.sparkSession)
    mark = uuid.uuid4().hex
    # Exploding one document is a plain column, except that Spark does not move
    # filters on the outcome below it, where they would parse the line again.
    decoded = lines.select("value", F.explode(F.array(_decode(F.col("value"), mark))).alias("_doc"))
    message = F.get("_doc.messages", F.lit(0))
    broken = (
        F.col("_doc.broken").isNotNull()
        | ~F.col("_doc.whole").eqNullSafe(F.lit(mark))
        | _closes_envelope(F.col("value"), mark)
        | ~F.is_valid_utf8("value")
        | message.isNull()
        | (F.size("_doc.messages") != 1)
    )
    # NULL means either an absent key or an explicit null. Only lines with a
    # NULL amount are looked at again to tell the two apart.
    absent = F.when(
        message["amount"].isNull(),
        ~F.array_contains(F.json_object_keys("value"), "amount"),
    )
    fields = decoded.select(
        "value",
        broken.alias("_broken"),
        *[message[name].alias(name) for name in EVENT_TEXT_FIELDS],
        F.when(absent, F.lit(0.0)).otherwise(_number(message["amount"])).alias("amount"),
    ).withColumn("amount", _finite(F.col("amount")))
    reason = F.when(F.col("_broken"), F.lit(MALFORMED))
    if missing_text is None:
        for name in EVENT_TEXT_FIELDS:
            reason = reason.when(F.col(name).isNull(), F.lit(f"missing {name}"))
        reason = reason.when(utc_instant(F.col("timestamp")).isNull(), F.lit(BAD_TIMESTAMP))
    else:
        fields = fields.fillna(missing_text, list(EVENT_TEXT_FIELDS))
    # A blank type cannot name a directory of the log.
    reason = reason.when(F.col("transaction_type") == "", F.lit(BLANK_TYPE))
    reason = reason.when(F.col("amount").isNull(), F.lit(BAD_AMOUNT))
    judged = fields.withColumn("reason", reason)
    extra = F.when(F.col("reason").isNull(), _unknown_fields(F.col("value"))).alias(EXTRA)
    return judged.select(
        *EVENT.fieldNames(),
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"),
        "reason",
        *([extra] if keep_unknown else []),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    extra = [EXTRA] if EXTRA in parsed.columns else []
    return parsed.where(F.col("reason").isNull()).select(*EVENT.fieldNames(), *extra)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")
