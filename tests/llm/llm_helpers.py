"""Tables and texts that the tests share."""


def spoken(random, n, words=400):
    """n words of a small invented vocabulary."""
    return [f"w{i}" for i in random.integers(0, words, n)]


def documents(spark, texts, extra=False):
    """A documents table with ids from 0; ``extra`` adds columns with clashing names."""
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        for name in ("size", "score", "t", "key", "g", "a", "_row", "_key", "start", "label", "n_words", "lot"):
            frame = frame.selectExpr("*", f"'kept' AS {name}")
    return frame


#: Texts that every operator must bear.
ODD = [None, "", " \t\n", "one", "one", "a b c d e", "x" * 300_000, "word " * 40_000, "　  😀 <b>&amp; > ok"]
