import corpus_pipeline
import pytest
from llm_helpers import ODD, documents, spoken

import __spark_entry__ as contract
from tellerbook.llm.mixing import mix_plan
from tellerbook.llm.near_dedup import near_duplicates
from tellerbook.llm.pii import pseudonymise
from tellerbook.llm.store import stored


@pytest.fixture
def folder_of(spark, random, tmp_path):
    """Documents with toxic words, copies and cards, and the labels of some."""
    texts = []
    for i in range(120):
        words = spoken(random, int(random.integers(20, 120)), 60)
        if i % 5 == 0:
            words[3] = "snarkwolt"
        if i % 7 == 0:
            words[5] = "4539578763621486"
        texts.append(" ".join(words))
    texts += [texts[1], texts[2] + " more", *ODD]
    frame = documents(spark, texts, extra=True)
    frame = frame.union(frame.where("doc_id IN (3, 5)"))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(110)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_each_stage_takes_effect(spark, folder_of):
    docs = spark.read.parquet(f"{folder_of}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder_of)
        if name != "packing":
            assert docs.columns == columns
            docs = stored(docs, "test")
        seen[name] = docs

    ids = {name: sorted(r.doc_id for r in seen[name].select("doc_id").collect()) for name in seen}
    toxic = set(range(0, 120, 5))
    assert set(range(120)) - set(ids["toxicity"]) == toxic
    classes = near_duplicates(seen["toxicity"], 80).where("kept").select("doc_id").distinct()
    assert ids["near_dedup"] == sorted(r.doc_id for r in classes.collect())
    assert {120, 121}.isdisjoint(ids["near_dedup"]) and ids["near_dedup"].count(3) == 1
    want = pseudonymise(seen["near_dedup"], corpus_pipeline.KEY).select(*columns)
    assert sorted(map(str, want.collect())) == sorted(map(str, seen["pii"].collect()))
    assert seen["pii"].where("text LIKE '%4539578763621486%'").count() == 0
    taken = {r.doc_id: r.taken for r in mix_plan(seen["pii"]).collect()}
    assert set(ids["mixing"]) == {k for k, n in taken.items() if n}
    assert ids["packing"] and set(ids["packing"]) == set(ids["mixing"])


def test_the_registered_pipeline_is_the_stages(spark, folder_of):
    rows = contract.queries()["pipeline"](spark, folder_of)
    pieces = rows.collect()
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{folder_of}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder_of)
    assert sorted(pieces) == sorted(docs.collect())


def test_empty_documents(spark, folder_of, tmp_path):
    docs = spark.read.parquet(f"{folder_of}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder_of)
    assert docs.collect() == []


def test_registered_names():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def kept_rows(spark, rows, columns="doc_id long, text string, lang string, source string, n_chars long"):
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], columns)
    out = corpus_pipeline.near_dedup_stage(spark, frame, "")
    assert out.columns == frame.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_each_text_of_an_id_counts(spark, random):
    one, two, three = (" ".join(spoken(random, 60, 5000)) for _ in range(3))
    rows = [(1, one), (1, two), (2, one + " end"), (3, three), (3, three), (None, three), (None, "null id " + three), (None, None), (1, "")]
    expected = sorted([(1, two), (2, one + " end"), (3, three), (None, None), (1, "")], key=str)
    assert kept_rows(spark, rows) == expected == kept_rows(spark, rows[::-1])


def test_null_ids_take_part_by_text(spark, random):
    texts = [" ".join(spoken(random, 50, 5000)) for _ in range(3)]
    rows = [(None, t) for t in texts for _ in range(4)] + [(7, texts[0])]
    assert kept_rows(spark, rows) == sorted([(7, texts[0]), (None, texts[1]), (None, texts[2])], key=str)


def test_ids_that_are_single_win(spark, random):
    text = " ".join(spoken(random, 50, 5000))
    assert kept_rows(spark, [(1, text), (1, text + " x"), (9, text), (9000, text + " y")]) == [(9, text)]
