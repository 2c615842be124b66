"""Graph search of nearest vectors against brute force."""
import math
import random

import numpy as np
import pytest

from fraudlake.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def brute(rows, k=20):
    """query_id -> [(vec_id, score)] over distinct (id, vector)."""
    use = {}
    for i, v, *_ in rows:
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            use[i, tuple(np.float32(c) for c in v)] = None
    out = {}
    for q, x in use:
        if q % 20 == 0:
            near = set()
            for i, y in use:
                if i != q and len(x) == len(y):
                    s = 0.0
                    for a, b in zip(x, y):
                        s += float(a) * float(b)
                    near.add((-s, i))
            out.setdefault(q, set()).update(near)
    return {q: [(i, -s) for s, i in sorted(near)[:k]] for q, near in out.items()}


def found(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA).repartition(parts)
    out = {}
    for r in sorted(vectors.nearest(df).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in want.items())
    return hits / max(1, sum(map(len, want.values())))


def exact(got, want):
    """Every score is that of brute force, where the pair is there."""
    for q, near in got.items():
        known = dict(want[q])
        assert all(s == known[i] for i, s in near if i in known)
        assert near == sorted(near, key=lambda r: (-r[1], r[0]))


@pytest.mark.parametrize("kind", ["unit", "lengths", "clusters"])
def test_recall_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 700)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 24))
    if kind == "clusters":
        x = rng.normal(size=(25, 24))[rng.integers(0, 25, 2000)] * 3 + x * 0.4
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "lengths":
        x *= rng.uniform(0.2, 3, (2000, 1))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got, want = found(spark, rows), brute(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    exact(got, want)
    assert recall(got, want) >= 0.95


def test_copies_and_odd_rows(spark):
    """A third of the rows are one vector; nulls, zeros and non-finite components take no part."""
    rng = random.Random(3)
    vec = lambda: [rng.gauss(0, 1) for _ in range(5)]
    hot = vec()
    rows = [(i, hot if i % 3 == 0 else vec()) for i in range(300)]
    rows += [(400, None), (420, []), (440, [0.0] * 5), (460, [1.0, None, 0.0, 0.0, 0.0]), (480, [math.inf] * 5), (500, [math.nan, 1.0, 1.0, 1.0, 1.0]), (None, hot)]
    rows += [(600 + 20 * i, [1.0, float(i)]) for i in range(5)]  # vectors of another length
    rows += rows[:50]
    got, want = found(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    exact(got, want)
    assert recall(got, want) >= 0.99
    assert [i for i, _ in got[0]] == [i for i, _ in want[0]]


def test_few_and_no_rows(spark):
    assert found(spark, []) == {}
    assert found(spark, [(20, [1.0])]) == {}
    assert found(spark, [(20, [1.0]), (21, [-2.0]), (22, [-2.0])]) == {20: [(21, -2.0), (22, -2.0)]}


def test_pruned_edges_stay_diverse():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [1.2, 0]], float)
    edges = vectors.prune(x, np.array([0]), np.array([[1, 2, 3, 4, 1, -1]]))
    assert edges[0, :2].tolist() == [1, 3] and sorted(edges[0, 2:4]) == [2, 4] and (edges[0, 4:] == -1).all()
