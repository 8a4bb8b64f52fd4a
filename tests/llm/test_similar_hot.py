"""A large group of near copies leaves about as many pairs as it has members, however many lists and blocks it is in."""

import random

import numpy as np
import pytest
from docledger.llm import similar
from tests.llm.test_similar import text


def copies_of_one(m):
    rng = random.Random(m)
    words = text(rng, 200)
    rows = []
    for k in range(m):
        again = list(words)
        again[rng.randrange(len(again))] = f"own{k}"
        rows.append((k, " ".join(again)))
    return rows


@pytest.mark.parametrize("block", [similar.BLOCK, 8])
def test_pairs_of_a_group_are_about_as_many_as_its_members(spark, monkeypatch, block):
    counts, components = [], similar.components
    monkeypatch.setattr(similar, "components", lambda edges: counts.append(edges.count()) or components(edges))
    monkeypatch.setattr(similar, "BLOCK", block)
    monkeypatch.setattr(similar, "SAMPLE", 1)
    monkeypatch.setattr(similar, "BYTES", 8 * 200 * min(block, 200))
    m = 120
    found = similar.grouped(spark.createDataFrame(copies_of_one(m), "doc_id long, text string")).collect()
    assert len(found) == m and len({r.component for r in found}) == 1
    assert len(counts) == 2 and max(counts) <= 2 * m


def joined(n, pairs):
    of = {x: x for x in n}
    for a, b in pairs:
        old, new = max(of[a], of[b]), min(of[a], of[b])
        of = {x: new if c == old else c for x, c in of.items()}
    return of


def test_pieces_of_two_blocks_add_what_joins_them():
    rng = np.random.default_rng(8)
    for blocks in (1, 2, 3, 5):
        for bits in (20, 30, 36):  # each is a step from one before it, so that chains of links run through the blocks
            prints = rng.integers(0, 256, (60, similar.HEAD)).astype(np.uint8)
            for k in range(20, 60):
                flips = np.zeros(8 * similar.HEAD, np.uint8)
                flips[rng.choice(len(flips), bits, replace=False)] = 1
                prints[k] = prints[rng.integers(k)] ^ np.packbits(flips)
            nodes = rng.permutation(np.arange(-300, 300, 10) + rng.integers(0, 10, 60))
            links = [(int(nodes[x]), int(nodes[y])) for x in range(60) for y in range(x) if np.bitwise_count(prints[x] ^ prints[y]).sum() <= similar.DIFFER]
            pairs = []
            for i in range(blocks):
                for j in range(i, blocks):
                    at = np.flatnonzero(np.isin(nodes % blocks, [i, j]))
                    if len(at) > 1:
                        pairs += similar.forest(nodes[at], prints[at], None, nodes[at] % blocks)
            assert all(a < b for a, b in pairs)
            assert joined(nodes.tolist(), pairs) == joined(nodes.tolist(), links)
