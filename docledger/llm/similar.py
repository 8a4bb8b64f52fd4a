"""Near-duplicates by the Jaccard similarity of their shingles: an inverted index of a wide SimHash's byte positions with count filtering, verified.

Words are those of simhash; a shingle is 5 words (of a text with fewer words, all of them) and a text stands for the set of its
shingles. Texts are linked if their sets have a Jaccard similarity of SIMILARITY = 0.8 or more; texts without words only with each other.

A fingerprint is a SimHash of PLACES bytes: a bit is 1 if more than half of the set's hashes, mixed anew for each 64 bits, have it. Two sets at a Jaccard
similarity of J = 0.8 differ in a bit with a chance of 0.15, so that a byte is shared with one of 0.27. The index lists texts by two positional bytes
at a time. A pair at J = 0.8 shares none of 128 lists with a chance of 0.928^128, seven in 100,000 (4 shingles of 5: some one in a hundred). Pairs in a list
that differ in more than DIFFER of the first 128 bits are dropped (one in a million at J = 0.8).

What remains are pairs that join all texts which candidates reach: of each group in a list, every text with the group's smallest. Their components are cut into blocks of
BYTES of shingles, and in each pair of blocks every text reached is compared with all not yet reached, first by the tally of shared bytes (SHARED or more) and then by the
sets themselves: no pair goes unseen because another one failed. Equal sets count once in all of this.

A list in blocks gives pairs within each block once, and for two blocks only those that join a group of one with a group of the other. The smallest texts that a text is
paired with, one for each list and block at most, are then joined with each other in its place. So a group of m copies in any number of lists leaves little more than m pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from docledger.lineage import cut, written
from docledger.llm.common import bounded, keep_first, sliced
from docledger.llm.components import components
from docledger.llm.passages import mixed, tokens_of, word_hashes
from docledger.llm.simhash import BLOCK

SIMILARITY = 0.8
BANDS = 128
PLACES = 2 * BANDS
SHARED = 28
#: Bytes that go with each entry of a list, and the most bits that differ in them.
HEAD, DIFFER = 16, 38
#: Lists are dealt out in blocks by how many of the nodes whose hash is a multiple of SAMPLE they hold.
SAMPLE = 64
#: Bytes of shingles, eight each, in a block.
BYTES = 4 << 20
#: Shingles that are counted at once: a count has a byte.
CHUNK = 255

_SEEDS = np.random.default_rng(19).integers(1, 1 << 63, PLACES // 8, np.int64).astype(np.uint64)
_ONES = np.uint64(0x0101010101010101)


def shingles(text: bytes | None) -> np.ndarray:
    """The hashes of a text's shingles (UTF-8), each once and in order."""
    words, _ = word_hashes(np.frombuffer(text or b"", np.uint8))
    if 0 < len(words) < 5:
        return np.array([xxh64_intdigest(words.tobytes(), 5)], np.uint64)
    return np.unique(tokens_of(words))


def fingerprint(found: np.ndarray) -> bytes:
    """Of a set that is not empty."""
    count = np.zeros((len(_SEEDS), 8, 8), np.int64)
    for k in range(0, len(found), CHUNK):
        words = mixed(found[k : k + CHUNK] ^ _SEEDS[:, None])
        for bit in range(8):  # the sums of eight bits stand side by side in a word
            count[:, :, bit] += np.add.reduce(words >> np.uint64(bit) & _ONES, axis=1).view(np.uint8).reshape(-1, 8)
    return np.packbits(2 * count > len(found), bitorder="little").tobytes()


def _node(found: np.ndarray) -> int:
    return int(np.uint64(xxh64_intdigest(found.tobytes(), 42)).view(np.int64))


def forest(nodes: np.ndarray, prints: np.ndarray, sets: list[np.ndarray] | None = None, blocks: np.ndarray | None = None) -> list[tuple[int, int]]:
    """The groups that links join, each as pairs of its smallest node with the others; nodes are linked that differ in DIFFER bits or less or, with sets, share SHARED bytes or more and are similar enough.

    Of two blocks: pairs of the smallest nodes of groups within a block, those that links between the blocks join.
    """

    def near(x: int, rest: np.ndarray) -> np.ndarray:
        if sets is None:
            return np.bitwise_count(prints[rest] ^ prints[x]).sum(1) <= DIFFER
        found = (prints[rest] == prints[x]).sum(1) >= SHARED
        if found.any():
            mine, at = sets[x], np.flatnonzero(found)
            size = np.array([len(sets[y]) for y in rest[at]])
            theirs = np.concatenate([sets[y] for y in rest[at]])
            hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
            found[at] = 10 * both >= round(10 * SIMILARITY) * (len(mine) + size - both)
        return found

    def groups(rest: np.ndarray):
        """Those of two and more."""
        while len(rest) > 1:
            group, rest, k = [int(rest[0])], rest[1:], 0
            while k < len(group) and len(rest):
                hit = near(group[k], rest)
                if hit.any():
                    group += rest[hit].tolist()
                    rest = rest[~hit]
                k += 1
            if len(group) > 1:
                yield group

    if blocks is None or (blocks == blocks[0]).all():
        return [(low, n) for group in groups(np.arange(len(nodes))) for low in [int(nodes[group].min())] for n in nodes[group].tolist() if n != low]

    side = (blocks != blocks[0]).astype(int)
    root = np.arange(len(nodes))
    for part in (0, 1):
        for group in groups(np.flatnonzero(side == part)):
            root[group] = group[np.argmin(nodes[group])]
    roots = np.unique(root)
    rest, reached, pairs = [np.flatnonzero(side == part) for part in (0, 1)], np.zeros(len(nodes), bool), []
    for first in roots[np.argsort(nodes[roots])].tolist():
        if reached[first]:
            continue
        front, new = [], [first]
        while front or new:
            for r in new:
                reached[r] = True
                front += np.flatnonzero(root == r).tolist()
                rest[side[r]] = rest[side[r]][root[rest[side[r]]] != r]
            x = front.pop()
            other = rest[1 - side[x]]
            new = np.unique(root[other[near(x, other)]]).tolist() if len(other) else []
            pairs += [(int(nodes[first]), int(nodes[r])) for r in new]
    return pairs


def _pieces(members: DataFrame, sizes: DataFrame, values: list[str]) -> DataFrame:
    """members (list, node, values) of each pair of blocks that a list of members is cut into, and the number of blocks; sizes: list and blocks, their number, of those in more than one.

    A node, a hash itself, lies in the block of its remainder.
    """
    placed = members.join(sizes, "list", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", F.pmod("node", "blocks").cast("int"))
    dealt = placed.select("list", "blocks", "node", *values, "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pieces = dealt.groupBy("list", "blocks", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).agg(F.collect_list(F.struct("node", *values)).alias("rows"))
    return pieces.select("rows", "blocks").where(F.size("rows") > 1)


def _lowered(pairs: DataFrame) -> DataFrame:
    """a, b (a < b), once each: the smallest of a node's smaller neighbours, which are one for each of its pieces at most, stays with it and is paired with the others in its place."""
    smaller = pairs.groupBy("b").agg(F.collect_set("a").alias("of")).withColumn("a", F.array_min("of"))
    moved = smaller.select(F.explode(F.transform("of", lambda x: F.struct("a", F.when(x == F.col("a"), F.col("b")).otherwise(x).alias("b")))).alias("pair"))
    return moved.select("pair.a", "pair.b").distinct()


def _linked(pieces: DataFrame, verify: bool) -> DataFrame:
    """a, b: pairs that join what the forests of pieces join, of each node but the smallest one with a smaller one, and few more."""

    def run(batches):
        for batch in sliced(batches):
            pairs = []
            for rows, blocks in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                rows = rows.values
                prints = np.frombuffer(b"".join(rows.field("fp").to_pylist()), np.uint8).reshape(len(rows), -1)
                sets = [np.frombuffer(s, np.uint64) for s in rows.field("found").to_pylist()] if verify else None
                nodes = rows.field("node").to_numpy()
                pairs += forest(nodes, prints, sets, nodes % blocks if blocks > 1 else None)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return _lowered(_lowered(pieces.mapInArrow(run, "a long, b long")))


def _sketched(texts: DataFrame, full: bool) -> DataFrame:
    """The columns of texts before its last one, the text; then node, fp (null without words) and, with full, found: the set."""
    names = texts.columns[:-1]
    kind = "".join(f"{n} {texts.schema[n].dataType.simpleString()}, " for n in names)

    def run(batches):
        for batch in sliced(batches):
            sets = [shingles(t) for t in batch.column(len(names)).cast(pa.binary()).to_pylist()]
            columns = [pa.array([_node(s) for s in sets], pa.int64()), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary())]
            columns += [pa.array([s.tobytes() for s in sets], pa.binary())] * full
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(names))] + columns, names=[*names, "node", "fp"] + ["found"] * full)

    return texts.mapInArrow(run, kind + "node long, fp binary" + ", found binary" * full)


def _listed(nodes: DataFrame) -> DataFrame:
    """list, node and fp (the first HEAD bytes) of each entry of the index of nodes."""

    def run(batches):
        for batch in sliced(batches):
            prints = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, PLACES)
            lists = prints.view("<u2").astype(np.int32) + (np.arange(BANDS, dtype=np.int32) << 16)
            heads = pa.array([p.tobytes() for p in prints[:, :HEAD]], pa.binary())
            row = pa.array(np.repeat(np.arange(len(prints)), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(lists.ravel()), batch.column(0).take(row), heads.take(row)], names=["list", "node", "fp"])

    return nodes.select("node", "fp").mapInArrow(run, "list int, node long, fp binary")


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, t (hash of the text) and component of each row."""
    bounded(docs.sparkSession)
    rows = written(_sketched(docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("t"), F.col(text).alias("text")), False))
    nodes = written(rows.where("fp is not null").groupBy("node").agg(F.min("fp").alias("fp")))
    counts = _listed(nodes.where(F.pmod("node", F.lit(SAMPLE)) == 0)).groupBy("list").agg(F.ceil(F.count("*") * SAMPLE / BLOCK).cast("int").alias("blocks"))
    reached = components(_linked(_pieces(_listed(nodes), written(counts.where("blocks > 1")), ["fp"]), False))

    once = rows.groupBy("node").agg(F.min("t").alias("t")).join(reached, "node").select("t", F.col("component").alias("list"))
    texts = docs.select(F.xxhash64(text).alias("t"), F.col(text).alias("text")).join(once, "t").dropDuplicates(["t"]).select("list", "text")
    sets = written(_sketched(texts, True))
    sizes = written(sets.groupBy("list").agg(F.ceil(F.sum(F.length("found")) / BYTES).cast("int").alias("blocks")).where("blocks > 1"))
    links = _linked(_pieces(sets, sizes, ["fp", "found"]), True)
    out = rows.join(components(links), "node", "left")
    return cut(out.select(F.col("key").alias(key), "t", F.coalesce("component", "node").alias("component")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The first row of each component (common.keep_first)."""
    return keep_first(docs, grouped(docs))
