import random

import pytest
from helpers import rows

import tellerbook.streaming.segments as segments
from tellerbook.sources.tables import folder_names
from tellerbook.streaming.segments import merge_updates, newest_rows, pieces, read_pieces
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("k", StringType()), StructField("v", LongType())])


def write(spark, path, batch, values):
    frame = spark.createDataFrame(list(values.items()), SCHEMA)
    frame.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")


def newest(spark, path):
    found = read_pieces(spark, path, SCHEMA, pieces(spark, path))
    return dict(rows(newest_rows(found, SCHEMA, ("k",)).drop("batch_id")))


def test_readers_see_the_same_rows_and_few_folders(spark, folder):
    rng, path, expected = random.Random(1), f"{folder}/log", {}
    most_seen = 0
    for batch in range(30):
        values = {f"k{rng.randrange(40)}": batch * 100 + i for i in range(rng.randint(1, 5))}
        write(spark, path, batch, values)
        expected |= values
        before = newest(spark, path)
        merge_updates(spark, path, SCHEMA, ("k",), most=4)
        assert before == newest(spark, path) == expected
        most_seen = max(most_seen, len(pieces(spark, path)))
    assert most_seen <= 8
    merge_updates(spark, path, SCHEMA, ("k",), most=4)
    assert len(folder_names(spark, path)) + len(folder_names(spark, f"{path}-merged")) <= 12


def test_the_newest_batch_is_never_merged(spark, folder):
    path = f"{folder}/log"
    for batch in range(6):
        write(spark, path, batch, {"a": batch})
    assert merge_updates(spark, path, SCHEMA, ("k",), most=2) == 5
    # A replay of the last batch writes it again.
    write(spark, path, 5, {"a": 50, "b": 1})
    assert newest(spark, path) == {"a": 50, "b": 1}


@pytest.mark.parametrize("step", ["write", "remove"])
def test_an_interrupted_merge_is_repeated(spark, folder, monkeypatch, step):
    path = f"{folder}/log"
    for batch in range(6):
        write(spark, path, batch, {"a": batch, f"k{batch}": batch})
    expected = newest(spark, path)
    if step == "write":
        # Half of a segment: data without _SUCCESS.
        target = f"{path}-merged/0-4"
        spark.createDataFrame([("a", -1, 99)], "k string, v long, batch_id long").write.parquet(target)
        segments.remove_folder(spark, f"{target}/_SUCCESS")
        assert newest(spark, path) == expected
    else:
        merge_updates(spark, path, SCHEMA, ("k",), most=2)
        removed = []

        def stops(spark, folder):
            if removed:
                raise OSError("lost")
            removed.append(folder)
            whole(spark, folder)

        whole = segments.remove_folder
        with monkeypatch.context() as patch:
            patch.setattr(segments, "remove_folder", stops)
            with pytest.raises(OSError):
                merge_updates(spark, path, SCHEMA, ("k",), most=2)
        assert newest(spark, path) == expected
    merge_updates(spark, path, SCHEMA, ("k",), most=2)
    assert newest(spark, path) == expected


def test_without_batches(spark, folder):
    assert pieces(spark, f"{folder}/none") == [] and newest(spark, f"{folder}/none") == {}
    assert merge_updates(spark, f"{folder}/none", SCHEMA, ("k",)) == 0
