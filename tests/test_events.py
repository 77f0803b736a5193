import json
import math
import random
from datetime import date

import pytest
from helpers import bronze, event, event_rows, lines, parsed, rows, without
from pyspark.sql import functions as F

from tellerbook.functions.columns import iso_text, utc_date, utc_instant
from tellerbook.operators.silver import silver_cast
from tellerbook.schemas import EVENT_TEXT_FIELDS
from tellerbook.sources.events import accepted, encode_events, parse_events, quarantined


def outcome(spark, item, **options):
    """(reason, amount) of one line."""
    return tuple(parsed(spark, [item], **options).select("reason", "amount").first())


@pytest.mark.parametrize(
    ("item", "reason", "amount"),
    [
        (event(), None, 100.0),
        (without(event(), "amount"), None, 0.0),
        (event(amount="12.5"), None, 12.5),
        (event(amount="1e3"), None, 1000.0),
        (event(amount=-5), None, -5.0),
        (event() | {"unknown": {"x": [1]}}, None, 100.0),
        (event(transaction_type="CHEQUE"), None, 100.0),
        (event(timestamp="2026-07-07T23:30:00-03:00"), None, 100.0),
        (event(timestamp="2026-07-07"), None, 100.0),
        (event(amount=None), "bad amount", None),
        (event(amount=math.nan), "bad amount", None),
        (event(amount="NaN"), "bad amount", None),
        (event(amount=math.inf), "bad amount", None),
        (event(amount="12.5d"), "bad amount", None),
        (event(amount="12.5f "), "bad amount", None),
        (event(amount=" 12.5 "), None, 12.5),
        (event(amount="ten"), "bad amount", None),
        (event(amount=True), "bad amount", None),
        (event(amount=[1]), "bad amount", None),
        (event(timestamp="None"), "bad timestamp", 100.0),
        (event(timestamp="12:30:00"), "bad timestamp", 100.0),
        (event(timestamp="2026"), "bad timestamp", 100.0),
        (event(timestamp="9:30-03:00"), "bad timestamp", 100.0),
        (event(timestamp="9:30-"), "bad timestamp", 100.0),
        (event(timestamp="12026-07-07T00:00:00"), "bad timestamp", 100.0),
        (event(timestamp="2026-W28-2"), "bad timestamp", 100.0),
        (event(timestamp="2026-7-7 1:02:03+02:00"), None, 100.0),
        (event(timestamp="2026-07"), "bad timestamp", 100.0),
        (event(timestamp="2026-02-30T00:00:00"), "bad timestamp", 100.0),
        (event(transaction_type=""), "blank transaction_type", 100.0),
        (without(event(), "transaction_id"), "missing transaction_id", 100.0),
        (event(transaction_id=None), "missing transaction_id", 100.0),
        (without(event(), "sender_account"), "missing sender_account", 100.0),
        (without(event(), "transaction_type"), "missing transaction_type", 100.0),
    ],
)
def test_line_outcome(spark, item, reason, amount):
    assert outcome(spark, item) == (reason, amount)


@pytest.mark.parametrize(
    "text",
    [
        "not json",
        "[1]",
        "5",
        "null",
        "",
        "   ",
        json.dumps([event()]),
        json.dumps(event())[:-1],
        json.dumps(event()) + " trailing",
        json.dumps(event()) + json.dumps(event("b")),
        json.dumps(event()) + "," + json.dumps(event("b")),
        json.dumps(event()) + "}",
        json.dumps(event()) + "}{",
        json.dumps(event()) + "]",
        json.dumps(event()) + "]}{",
        json.dumps(event()) + ', "amount": 1',
        json.dumps(event()) + ', "x": {}',
        json.dumps(event()).replace('"', "'"),
        json.dumps(event()) + '],"x":[1',
        json.dumps(event()) + '],"whole":true,"y":[{"z":1}',
        json.dumps(event()) + '],"whole":true} junk',
        '{"transaction_id":"lost"}],"messages":[' + json.dumps(event()),
        json.dumps(event()) + '],"messages":[' + json.dumps(event("b")),
    ],
)
def test_malformed_lines_are_kept_whole(spark, text):
    frame = parsed(spark, [text])
    assert [tuple(r) for r in quarantined(frame).collect()] == [(text, "malformed")]
    assert accepted(frame).count() == 0


def test_text_that_is_not_utf8_is_rejected(spark):
    raw = json.dumps(event(sender_account="341-?8765")).encode().replace(b"?", b"\xff")
    frame = spark.createDataFrame([(bytearray(raw),)], "raw binary").selectExpr("CAST(raw AS string) AS value")
    assert [r.reason for r in quarantined(parse_events(frame)).collect()] == ["malformed"]


def test_brackets_inside_a_line_are_no_fault(spark):
    assert outcome(spark, event(sender_account="a]}") | {"list": [1, [2]]}) == (None, 100.0)


def test_no_line_is_lost(spark):
    items = [event(str(i)) for i in range(5)] + ["junk", event(amount=None)]
    frame = parsed(spark, items)
    assert frame.count() == len(items)
    assert accepted(frame).count() + quarantined(frame).count() == len(items)


def test_missing_text_mode_keeps_keyless_rows(spark):
    items = [without(event(), "transaction_id"), without(event("b"), "timestamp"), "junk"]
    frame = parsed(spark, items, missing_text="None")
    kept = {(r.transaction_id, r.timestamp) for r in accepted(frame).collect()}
    assert kept == {("None", "2026-07-07T12:00:00"), ("b", "None")}
    silver = silver_cast(accepted(frame)).where("transaction_id = 'b'").first()
    assert silver.transaction_timestamp is None


def test_last_of_a_repeated_key_counts(spark):
    text = json.dumps(event())[:-1] + ', "transaction_id": "z"}'
    assert bronze(spark, [text]).first().transaction_id == "z"


def test_roundtrip_restores_rows(spark):
    items = [event(str(i), amount=a) for i, a in enumerate([0.1, 1e9, 12345678.91, 0.0])]
    items.append(event('q"uo\\te\n', sender_account="çã"))
    frame = event_rows(spark, items)
    again = accepted(parse_events(encode_events(frame)))
    assert rows(again) == rows(frame)


def test_null_fields_are_written_and_rejected(spark):
    frame = event_rows(spark, [event(sender_account=None)])
    text = encode_events(frame).first().value
    assert json.loads(text)["sender_account"] is None
    assert parse_events(encode_events(frame)).first().reason == "missing sender_account"


@pytest.mark.parametrize(
    ("text", "day", "seconds"),
    [
        ("2026-07-07T23:59:59", date(2026, 7, 7), 1783468799),
        ("2026-07-07 23:59:59", date(2026, 7, 7), 1783468799),
        ("2026-07-07T23:59:59Z", date(2026, 7, 7), 1783468799),
        ("2026-07-07T23:59:59.000000+00:00", date(2026, 7, 7), 1783468799),
        ("2026-07-07T23:30:00-03:00", date(2026, 7, 8), 1783477800),
        ("2026-07-07T23:30:00 America/Sao_Paulo", date(2026, 7, 8), 1783477800),
        ("2026-07-07", date(2026, 7, 7), 1783382400),
        (" 2026-07-07 ", date(2026, 7, 7), 1783382400),
        ("1969-12-31T23:59:59", date(1969, 12, 31), -1),
    ],
)
def test_instants_do_not_depend_on_the_session_zone(spark, other_zone, text, day, seconds):
    frame = spark.createDataFrame([(text,)], "t string").select(utc_instant(F.col("t")).alias("i"))
    seen = frame.select(utc_date(F.col("i")), F.unix_seconds("i")).first()
    assert tuple(seen) == (day, seconds)


def test_iso_text(spark, other_zone):
    frame = spark.sql("SELECT timestamp_ntz'2026-07-07 01:02:03.5' AS a")
    assert frame.select(iso_text(F.col("a"))).first()[0] == "2026-07-07T01:02:03.5"


def test_parsing_stays_in_the_jvm(spark):
    plan = parse_events(lines(spark, [event()]))._jdf.queryExecution().toString()
    assert "Python" not in plan.split("== Physical Plan ==")[1]


def altered(rng, text):
    """The text with one small accident."""
    at, char = rng.randrange(len(text)), rng.choice('{}[]",:0189.-+e \\tn/#')
    return rng.choice(
        [
            text[:at] + char + text[at:],
            text[:at] + text[at + 1 :],
            text[:at] + char + text[at + 1 :],
            text + text[at:],
        ]
    )


def judged(text):
    """What a plain reading makes of a line: its fate up to the timestamp."""
    try:
        fields = json.loads(text)
    except ValueError:
        return "malformed"
    if not isinstance(fields, dict):
        return "malformed"
    for name in EVENT_TEXT_FIELDS:
        if fields.get(name) is None:
            return f"missing {name}"
    try:
        number = float(fields.get("amount", 0.0))
    except (TypeError, ValueError):
        number = math.nan
    return number if math.isfinite(number) else "bad amount"


def test_altered_lines_meet_the_fate_of_a_plain_reading(spark):
    rng = random.Random(11)
    whole = [
        json.dumps(event()),
        json.dumps(event(amount="12.5")),
        json.dumps(without(event(), "amount")),
        json.dumps(event() | {"more": {"y": [1, {"z": None}]}}),
    ]
    texts = sorted({altered(rng, rng.choice(whole)) for _ in range(3000)})
    frame = parsed(spark, texts)
    rejected = {r.value: r.reason for r in quarantined(frame).collect()}
    assert frame.count() == len(texts)
    for text in texts:
        fate, reason = judged(text), rejected.get(text)
        # A damaged timestamp or type is judged by other rules.
        if reason not in ("bad timestamp", "blank transaction_type"):
            assert reason == (fate if isinstance(fate, str) else None), text
    kept = sorted(r.amount for r in accepted(frame).collect())
    assert kept == sorted(judged(t) for t in texts if t not in rejected)


def test_lines_are_parsed_once_whatever_is_asked(spark):
    frame = parse_events(lines(spark, [event()]))
    for part in (frame, accepted(frame), quarantined(frame)):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1


def test_parsing_keeps_generated_methods_to_what_the_jvm_compiles(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        for given, then in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(name, given)
            parse_events(spark.createDataFrame([("{}",)], "value string"))
            assert spark.conf.get(name) == then
    finally:
        spark.conf.set(name, before)
