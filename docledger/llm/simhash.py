"""SimHash near-duplicates by an inverted index of byte positions with count filtering.

Fingerprint: A-Z are lower-cased, words are what stands between ASCII blanks, a shingle is SHINGLE words joined by
single spaces (of a text with fewer words, all of them), repeats included; a bit is 1 if more than half of the
shingles' XXH64 (seed 42) have it. A text without words, null included, has fingerprint 0 and links like any other.

Two fingerprints that differ in at most BITS = 4 bits share at least 8 - 4 = 4 of their 8 positional bytes, and each
four positions hold one of the 20 TRIPLES. So the index lists fingerprints by three positional bytes at a time; in a
list, the shared positional bytes of a pair are tallied, pairs below 4 are dropped, and the rest verified (5 to 7 bits
go the same way by two bytes or one, with lists that are longer by 256 each time). Of the links in
a list a spanning forest is kept, which joins the same documents with fewer pairs than the list has members. Lists
of more than BLOCK fingerprints are cut into blocks, and each pair of blocks is a task's work of its own.
Equal fingerprints count once in all of this.

Repeated rows are rows of the result; a null id is no component's name (a component of null ids alone has none).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.lineage import cut, written
from docledger.llm.common import bounded, keep_first, sliced
from docledger.llm.components import components

SHINGLE = 4
BITS = 4
SEED = 42
#: Most fingerprints that are compared in one piece.
BLOCK = 2048

#: Positions fall into three groups in a ring; a triple lies in one group, or has two in a group and one in the next.
_GROUP = (0, 0, 0, 1, 1, 1, 2, 2)
TRIPLES = tuple(t for t in combinations(range(8), 3) if (g := sorted(_GROUP[p] for p in t)) and (g[0] == g[2] or g in ([0, 0, 1], [1, 1, 2], [0, 2, 2])))


def positions(bits: int) -> tuple[tuple[int, ...], ...]:
    """Sets of positions, one of which lies in any 8 - bits positions: what the index lists fingerprints by."""
    if bits <= 4:
        return TRIPLES
    if bits == 5:  # two of any three lie in the same half
        return tuple((a, b) for a, b in combinations(range(8), 2) if a // 4 == b // 4)
    if bits > 7:
        raise ValueError("fingerprints that differ in more than 7 bits may share no byte")
    return tuple(combinations(range(8), 8 - bits))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Of a text in UTF-8."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(whole, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stop = np.cumsum(size)
    begin, end = (stop - size)[: len(words) - shingle + 1].tolist(), (stop[shingle - 1 :] - 1).tolist()
    count, n = np.zeros(64, np.int64), len(begin)
    for k in range(0, n, 1 << 15):
        h = np.array([xxh64_intdigest(whole[s:e], SEED) for s, e in zip(begin[k : k + (1 << 15)], end[k : k + (1 << 15)], strict=True)], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """key and fp (a long with the fingerprint's bits) of each row."""
    bounded(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in sliced(batches):
            found = np.array([fingerprint(t, shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["key", "fp"])

    out = docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, f"key {kind}, fp long")
    return out.withColumnRenamed("key", key)


def forest(found: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links between different fingerprints of one list."""
    rest, pairs = found.astype(np.int64).view(np.uint64), []
    front: list = []
    while len(rest) or front:
        if not front:
            front, rest = [rest[0]], rest[1:]
        x = front.pop()
        differ = rest ^ x
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        near = shared >= 8 - bits
        near[near] = np.bitwise_count(differ[near]) <= bits
        if near.any():
            mine, rest = rest[near], rest[~near]
            pairs += [(int(x.view(np.int64)), int(y.view(np.int64))) for y in mine]
            front += list(mine)
    return pairs


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """a, b: pairs of different fingerprints (column fp) that differ in at most bits bits, enough of them to join all that are linked."""
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = [reduce(lambda x, y: x + y, [F.shiftleft(byte[p], 8 * n) for n, p in enumerate(places)], F.lit(k << 24)) for k, places in enumerate(positions(bits))]
    index = fps.select("fp").distinct().select("fp", F.explode(F.array(*keys)).alias("list"))
    sizes = index.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    placed = index.join(sizes, "list").select("list", "fp", blocks.alias("blocks")).select("list", "fp", "blocks", mine.alias("mine"))
    # a list in one block is one piece; else a fingerprint goes to each piece that pairs its block with another
    dealt = placed.select("list", "fp", "mine", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("other"))
    pieces = dealt.groupBy("list", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).agg(F.collect_list("fp").alias("fps"))

    def run(batches):
        for batch in sliced(batches):
            lists = batch.column(0)
            values, ends = lists.flatten().to_numpy(), np.cumsum(np.diff(lists.offsets.to_numpy()))
            pairs = [p for part in np.split(values, ends[:-1]) for p in forest(part, bits)] if len(lists) else []
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    return pieces.select("fps").where(F.size("fps") > 1).mapInArrow(run, "a long, b long")


def grouped(fps: DataFrame, key: str = "doc_id", bits: int = BITS) -> DataFrame:
    """fps (key, fp) with component_id: the smallest key of all rows that links reach, the row's own included."""
    of = components(links(fps, bits).distinct()).withColumnRenamed("node", "fp")
    # a row for each fingerprint; sums are written before they are joined, so that a hot fingerprint's or component's rows can be split
    once = written(fps.groupBy("fp").agg(F.min(key).alias("first")).join(of, "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    least = written(once.groupBy("component").agg(F.min("first").alias("component_id")))
    named = written(once.select("fp", "component").join(least, "component").select("fp", "component_id"))
    return fps.join(named, "fp").select(key, "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id."""
    found = grouped(cut(fingerprints(docs)))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The first row of each component (common.keep_first)."""
    rows = docs.select(F.struct("doc_id", F.xxhash64("text").alias("t")).alias("row"), "text")
    found = cut(grouped(cut(fingerprints(rows, "row", shingle=shingle)), "row", bits))
    return keep_first(docs, found.select("row.doc_id", "row.t", F.col("component_id").alias("component")))
