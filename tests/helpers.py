"""Small event sets and plain-Python twins of silver and gold."""

from __future__ import annotations

import itertools
import json
import os
from collections import defaultdict
from datetime import UTC, datetime

from pyspark.sql import functions as F

from tellerbook.schemas import EVENT
from tellerbook.sources.events import accepted, parse_events


def event(id="a", timestamp="2026-07-07T12:00:00", amount=100.0, **changes):
    fields = {
        "transaction_id": id,
        "timestamp": timestamp,
        "sender_account": "341-98765",
        "receiver_account": "102-55555",
        "transaction_type": "PIX",
        "amount": amount,
    }
    return fields | changes


def without(fields, *names):
    return {k: v for k, v in fields.items() if k not in names}


def lines(spark, items):
    """JSON text for dicts, the text itself for strings."""
    texts = [(i if isinstance(i, str) else json.dumps(i),) for i in items]
    return spark.createDataFrame(texts, "value string")


def parsed(spark, items, **options):
    return parse_events(lines(spark, items), **options)


def bronze(spark, items):
    return accepted(parsed(spark, items))


def event_rows(spark, items):
    return spark.createDataFrame([tuple(i[n] for n in EVENT.fieldNames()) for i in items], EVENT)


def rows(frame):
    """Rows as tuples, instants as epoch seconds, in a fixed order."""
    plain = [
        F.unix_micros(c).alias(c) if t == "timestamp" else F.col(c) for c, t in frame.dtypes
    ]
    return sorted(map(tuple, frame.select(*plain).collect()), key=repr)


def gold_by_hand(items, threshold=10_000.0):
    """Latest version per id by full order, then daily sums of whole cents."""
    latest = {}
    for e in items:
        moment = datetime.fromisoformat(e["timestamp"])
        moment = moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment
        version = (
            moment.astimezone(UTC),
            e["sender_account"],
            e["receiver_account"],
            e["transaction_type"],
            e["amount"],
        )
        key = e["transaction_id"]
        if key not in latest or version > latest[key]:
            latest[key] = version
    groups = defaultdict(list)
    for moment, sender, _, kind, amount in latest.values():
        groups[(moment.date(), sender, kind)].append(round(amount * 100))
    limit = threshold * 100
    return sorted(
        (
            (
                *key,
                len(cents),
                sum(cents) / 100,
                sum(c > limit for c in cents),
                sum(c for c in cents if c > limit) / 100,
            )
            for key, cents in groups.items()
        ),
        key=repr,
    )


_landed = itertools.count(1)


def lands(folder, name, items, days_old=0):
    """Put a file of messages into a landing folder, later than the ones before
    unless ``days_old``."""
    os.makedirs(folder, exist_ok=True)
    text = "\n".join(i if isinstance(i, str) else json.dumps(i) for i in items)
    hidden = f"{folder}/.{name}"
    with open(hidden, "w") as file:
        file.write(text + "\n")
    moment = 1_700_000_000 + next(_landed) - 86_400 * days_old
    os.utime(hidden, (moment, moment))
    os.replace(hidden, f"{folder}/{name}")
