import random
from collections import Counter

from docledger.llm import similar


def jaccard(a, b):
    x, y = (set(similar.shingles(t.encode()).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def text(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))) for _ in range(n)]


def copies(seed, n=60):
    """Texts and copies of them with a similarity of 0.8 to 0.9, words replaced, put in and left out."""
    rng = random.Random(seed)
    pairs = []
    while len(pairs) < n:
        words = text(rng, rng.randrange(60, 300))
        again = list(words)
        for _ in range(rng.randrange(1, 1 + len(words) // 40)):
            k = rng.randrange(len(again))
            again[k : k + rng.randrange(2)] = ["new"] * rng.randrange(2)
        a, b = " ".join(words), " ".join(again)
        if 0.8 <= jaccard(a, b) <= 0.9:
            pairs.append((a, b))
    return pairs


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(3)
    pairs = copies(1)
    alone = [" ".join(text(rng, rng.randrange(1, 120))) for _ in range(60)]
    rows = [(k, a) for k, (a, _) in enumerate(pairs)] + [(100 + k, b) for k, (_, b) in enumerate(pairs)] + [(200 + k, t) for k, t in enumerate(alone)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.keep_one(docs).collect()) == [*range(60), *range(200, 260)]


def test_links_are_verified_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    words = text(rng, 100)
    chain = [" ".join([*words[k * 6 :], *[f"x{j}" for j in range(k * 6)]]) for k in range(12)]  # each like its neighbour alone
    assert jaccard(chain[0], chain[1]) >= 0.8 > jaccard(chain[0], chain[2])
    rows = [(k, t) for k, t in enumerate(chain) if k != 6]
    for size in (similar.BYTES, 2000):
        monkeypatch.setattr(similar, "BYTES", size)
        got = {r.doc_id: r.component for r in similar.grouped(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert len({got[k] for k in range(6)}) == 1 and len({got[k] for k in range(7, 12)}) == 1 and got[0] != got[7]


def test_short_and_empty_texts_and_rows_of_one_id(spark):
    from docledger.llm import simhash

    rng = random.Random(9)
    near_zero = next(t for t in (" ".join(text(rng, 6)) for _ in range(20_000)) if simhash.fingerprint(t.encode(), 5).bit_count() <= 6)
    rows = [(1, None), (2, " "), (3, near_zero), (4, "a b"), (4, "c d"), (5, "A  b"), (4, "c d"), (None, "a b"), (None, "e f"), (None, "e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.keep_one(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, None), (3, near_zero), (4, "a b"), (4, "c d"), (None, "e f")])
    assert similar.keep_one(docs.limit(0)).count() == 0
