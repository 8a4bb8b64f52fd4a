import math
import random
from collections import defaultdict

import numpy as np
import pytest
from docledger.llm import neighbours


def brute(rows, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in zip(ids, x, strict=True):
        if i % 20 == 0:
            s = np.add.reduce(x * v, axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in w}) / len(w) for q, w in want.items()])


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(neighbours.turned(x, 2), axis=1), np.linalg.norm(x, axis=1))


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want, got = brute(rows), found(neighbours.digest(table))
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.9
    for q, pairs in got.items():
        assert len(pairs) == 20 and [p[0] for p in pairs] == [p[0] for p in sorted(pairs, key=lambda p: (-p[1], p[0]))]
        exact = dict(want[q])
        assert all(math.isclose(s, exact[v], abs_tol=1e-12) for v, s in pairs if v in exact)


def test_other_lengths_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(k, (v * rng.uniform(0.2, 3)).astype(float).tolist()) for k, v in enumerate(rng.normal(size=(700, 10)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(found(neighbours.digest(table)), brute(rows)) >= 0.9


def test_copies_are_exact_and_hostile_rows_take_no_part(spark):
    rng = random.Random(8)
    one = [rng.gauss(0, 1) for _ in range(8)]
    good = [(k, list(one)) for k in range(100, 400)] + [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(30)]
    bad = [(500, None), (520, [0.0] * 8), (540, [float("nan")] + [1.0] * 7), (560, [float("inf")] * 8), (580, [None] + [1.0] * 7), (600, []), (None, one)]
    more = [(620, [1.0, 2.0]), (640, [1.0, 3.0]), (0, good[300][1])]
    table = spark.createDataFrame([(i, v, 0) for i, v in good + bad + more], "vec_id long, embedding array<double>, id int")
    got, want = found(neighbours.digest(table)), brute(good)
    for q in range(100, 400, 20):
        assert got[q] == want[q]
    assert got[620] == [(640, 7.0)] and got[640] == [(620, 7.0)]
    assert set(got) == set(want) | {620, 640}
    assert neighbours.digest(table.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 15, 21, 30, 60])
def test_few_vectors_are_all_found(spark, n):
    rng = np.random.default_rng(n)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(n, 64)))]
    got, want = found(neighbours.digest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))), brute(rows)
    assert {q: [v for v, _ in w] for q, w in got.items()} == {q: [v for v, _ in w] for q, w in want.items() if w}


@pytest.mark.parametrize("n", [2_000, 20_000, 100_000])
def test_recall_holds_while_the_share_falls(n):
    """Of evenly scattered unit vectors, by the buckets of the search itself."""
    x = np.random.default_rng(7).normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, seen = x[:50], np.zeros((50, n), bool)
    share = neighbours.share_of(n)
    for t in range(neighbours.TABLES):
        first, second = neighbours._signed(q, t)
        one, two = np.divmod(neighbours.codes(x, t), 128)
        seen |= first[:, one] + second[:, two] >= neighbours.limits(first, second, share)[:, None]
    score = q @ x.T
    score[np.arange(50), np.arange(50)] = -2
    top = np.argpartition(-score, 20, axis=1)[:, :20]
    assert np.take_along_axis(seen, top, 1).mean() >= 0.9
    assert seen.mean() <= {2_000: 0.42, 20_000: 0.28, 100_000: 0.2}[n]
