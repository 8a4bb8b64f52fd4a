import random
import zlib

import pytest
from docledger.llm import toxicity

SYLLABLES = ["an", "the", "re", "tion", "ou", "ing", "st", "er", "nd", "ha"]
INSULTS = ["dreckling", "vollpfosten", "scumbucket"]


def texts(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 120))]
        toxic = int(k % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((" ".join(words), toxic))
    return rows


def test_unseen_texts_are_told_apart():
    scorer = toxicity.Scorer(toxicity.fit_texts(texts(600, 1)))
    found = [(scorer.score(t), y) for t, y in texts(300, 2)]
    assert sum((s >= 0.7) == y for s, y in found) / len(found) > 0.95
    assert scorer.score(None) == scorer.score("") == scorer.score("  12 .,") == 0.0
    assert 0 <= scorer.score("x" * 300_000) <= 1


def test_fit_repeats_exactly_and_copies_do_not_count_twice():
    assert toxicity.fit_texts(texts(200, 3)) == toxicity.fit_texts(texts(200, 3))
    rows = [(b"a b c", 1)] * 5 + [(b"a b c", 0)]
    assert toxicity.unlike(rows) == [(b"a b c", 1), (b"a b c", 0)]


def test_one_class_or_none():
    assert toxicity.Scorer(toxicity.fit_texts([])).score("a") == 0.5
    assert toxicity.Scorer(toxicity.fit_texts([("a", 0)] * 9)).score("a") < 0.1


def test_rows(spark):
    rows = [(k, t, y) for k, (t, y) in enumerate(texts(400, 4))]
    docs = spark.createDataFrame([(k, t, "x") for k, t, _ in rows] + [(None, None, None), (0, rows[0][1], "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, y, 0) for k, _, y in rows] + [(None, 1, 0), (3, None, 0)], "doc_id long, toxic int, text int")
    got = toxicity.digest(docs, labels).collect()
    assert len(got) == 402
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7)
    by_id = {r.doc_id: r.predicted for r in got}
    kept = [k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert sum(by_id[k] == rows[k][2] for k in kept) / len(kept) > 0.9
    model = toxicity.fit(docs, labels)
    assert {r.doc_id for r in toxicity.keep_ordinary(docs, model).collect()} == {k for k, p in by_id.items() if not p}
    assert toxicity.digest(docs.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("size", ["sf0.1"])
def test_held_out_labels(spark, size):
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.digest(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.95
    toxic = [r.predicted for r in got if r.toxic]
    assert sum(toxic) / len(toxic) > 0.5  # some 300 toxic texts in four languages to learn from
