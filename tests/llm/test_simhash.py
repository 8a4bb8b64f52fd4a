import random
from collections import Counter
from itertools import combinations

import numpy as np
import xxhash
from docledger.llm import components, simhash


def plain(text, k=4):
    words = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows, bits=4):
    """component of each row of (id, fingerprint), by brute force."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
            parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(rows))]


def test_triples_cover_all_fours():
    assert len(simhash.TRIPLES) == 20
    for bits in range(1, 8):
        assert all(any(set(t) <= set(same) for t in simhash.positions(bits)) for same in combinations(range(8), 8 - bits))


def test_fingerprints_equal_the_definition():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("aB é\t\x85\x1c\n cÄ") for _ in range(rng.randrange(120)))
        assert simhash.fingerprint(text.encode()) == plain(text)
    long = " ".join(rng.choice("abcde") for _ in range(70_000))
    assert simhash.fingerprint(long.encode()) == plain(long)


def test_random_links(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for d in range(400):
        fp = rng.getrandbits(64) if not rows or rng.random() < 0.3 else rng.choice(rows)[1]
        for _ in range(rng.randrange(7)):
            fp ^= 1 << rng.randrange(64)
        rows.append((d if d % 50 else None, fp))
    table = spark.createDataFrame([(d, int(np.uint64(f).view(np.int64))) for d, f in rows], "doc_id long, fp long")
    want = Counter(zip([d for d, _ in rows], groups(rows), strict=True))
    for block in (2048, 16):
        monkeypatch.setattr(simhash, "BLOCK", block)
        assert Counter((r.doc_id, r.component_id) for r in simhash.grouped(table).collect()) == want


    for bits in (2, 5, 6):
        want = Counter(zip([d for d, _ in rows], groups(rows, bits), strict=True))
        assert Counter((r.doc_id, r.component_id) for r in simhash.grouped(table, bits=bits).collect()) == want


def test_long_paths(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1000), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {k: 0 for k in range(301)} | {1000: 1000, 1001: 1000}


def test_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, plain(r.text)) for r in docs.collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.digest(docs).collect()}
    assert got == {d: (f"{f:016x}", c) for (d, f), c in zip(rows, groups(rows), strict=True)}
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == {c for _, c in got.values()}


def test_edge_rows(spark):
    words = " ".join(f"w{k}" for k in range(50))
    rows = [(4, words, 1), (4, words, 1), (2, words.upper(), 2), (7, None, 3), (8, " \n", 4), (None, words, 5), (None, "some other words here now", 6), (None, "some other words here now", 6), (9, "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = Counter((r.doc_id, r.component_id) for r in simhash.digest(docs).collect())
    assert got == Counter({(4, 2): 2, (2, 2): 1, (7, 7): 1, (8, 7): 1, (None, 2): 1, (None, None): 2, (9, 9): 1})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(2, words.upper()), (7, None), (9, "x"), (None, "some other words here now")])
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c")], "doc_id long, text string")
    assert simhash.keep_one(twice).count() == 1
    assert simhash.digest(docs.limit(0)).count() == 0
