import math

import numpy as np
import pytest

from tellerbook.llm import vector_dedup
from tellerbook.llm.vector_dedup import close_pairs, near_vectors, quantised

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def brute(rows, cosine):
    good = {}
    for k, (i, v, label) in enumerate(rows):
        usable = v and all(x is not None and math.isfinite(x) for x in v) and any(v) and label is not None
        if usable and i is not None:
            good[k] = (np.array(v, np.float32).astype(float), label)
    links = {k: set() for k in range(len(rows))}
    for a, (x, p) in good.items():
        for b, (y, q) in good.items():
            if a != b and p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[a].add(b)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, edge = {k}, [k]
        while edge:
            edge = [b for a in edge for b in links[a] if b not in seen and not seen.add(b)]
        least = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((i, len(links[k]), least, i is None or i == least))
    return sorted(out, key=str)


def check(spark, rows, cosine=0.98):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    found = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(frame, cosine).collect()]
    assert sorted(found, key=str) == brute(rows, cosine)


@pytest.mark.parametrize("tile", [16, 1024])
def test_links_equal_brute_force(spark, random, monkeypatch, tile):
    monkeypatch.setattr(vector_dedup, "TILE", tile)
    rows = []
    for _ in range(30):
        base = random.normal(size=16)
        for _ in range(int(random.integers(1, 6))):
            v = base + random.normal(size=16) * random.choice([0, 0.05, 0.2, 0.3])
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)], int(random.integers(0, 2))))
    check(spark, rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1),
        (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.0], 1), (11, [1e-30, 0.0], 1), (12, [3e38, 0.0], 1), (13, [-1.0, 0.0], 1),
    ]
    check(spark, rows)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_bound_holds(random):
    x = random.normal(size=(200, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = quantised(x)
    exact, coded = x @ x.T, (q.astype(float) @ q.astype(float).T) * np.outer(s, s)
    assert (np.abs(exact - coded) <= e[None, :] + e[:, None] * (1 + e[None, :]) + 1e-12).all()


def test_close_pairs_of_wide_vectors(random):
    x = random.normal(size=(40, 1500))
    y = np.vstack([x[:10] + 0.1 * random.normal(size=(10, 1500)), random.normal(size=(20, 1500))])
    i, j = close_pairs(x, y, 0.98)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(k, k) for k in range(10)]
