import hashlib
import random
from collections import Counter

from docledger.llm import substrings


def plain(rows, size=200):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[p : p + size] for t in texts for p in range(len(t) - size + 1))
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - size + 1):
            if count[t[p : p + size]] > 1:
                gone[p : p + size] = b"\1" * size
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(t)) if gone[p] and not (p and gone[p - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeiou stré\n") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randrange(30, 200)) for _ in range(8)]
    rows = []
    for d in range(80):
        parts = [text(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts += [s[a : a + rng.randrange(900)], text(rng.randrange(40))]
        rows.append((d, "".join(parts)))
    near = text(300)
    for d in range(80, 100):
        at = rng.randrange(len(near))
        rows.append((d, near[:at] + word() + near[at:]))
    period = word() + "x"
    rows += [(100, rows[3][1]), (101, period * 200), (102, "a" * 600), (103, "b" * 200), (104, "c" * 201), (105, None), (106, ""), (None, shared[0]), rows[5], rows[5]]
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = made(4)
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    want = plain(rows)
    assert Counter(tuple(r) for r in substrings.digest(docs).collect()) == want
    for name, value in (("CHUNK", 1500), ("HOT", 2), ("SHARD", 4000)):
        monkeypatch.setattr(substrings, name, value)
    assert Counter(tuple(r) for r in substrings.digest(docs).collect()) == want


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in substrings.digest(docs).collect()) == plain(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert substrings.digest(docs.limit(0)).count() == 0
    assert [tuple(r)[:4] for r in substrings.digest(docs).collect()] == [(1, 1, 0, 0)]
