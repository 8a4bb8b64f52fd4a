"""Exact substring dedup: every byte that a SIZE-byte string covers which also starts elsewhere goes.

Texts are UTF-8; strings do not cross texts; strings are judged on the input. Suffix arrays (docledger.llm.suffixes) of shards
find the repeats; the shards are made so that equal strings meet:

1. Of the GRAM-byte strings within each window of SIZE bytes, the one with the smallest hash (the leftmost of equals) is the window's anchor.
   It depends on the window's bytes alone, so equal windows have equal anchors. Neighbouring windows with the same
   anchor form a segment, some 290 bytes of text for 85 windows. A segment is known by its place and two hashes, of the anchor
   and of the segment, and only segments whose anchor occurs twice are kept.
2. Equal segments are repeated as a whole. Where segments with one anchor differ, one of each kind is fetched from
   its text and dealt to a shard by its anchor.
3. A shard's pieces are joined, its suffix array induced, its permuted common prefixes computed: a window is repeated if it
   shares SIZE bytes with a neighbour in the array.
4. An anchor with more than HOT kinds of segments is no shard's: its windows are compared by 128-bit hashes, in a count that is
   pre-aggregated and dealt by the hash.

What is shuffled besides texts (twice) is in proportion to the text over 85. A row's identity is its id and the hash of its text;
rows equal in both repeat each other and fare alike. Null text is empty, a null id is an id like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.lineage import written
from docledger.llm import suffixes
from docledger.llm.common import bounded, sliced

SIZE = 200
GRAM = 32
#: Bytes that are searched for anchors at once; places within them must fit the hash's low 20 bits.
CHUNK = 1 << 19
#: Bytes of a shard, and most kinds of segments with one anchor that are one shard's.
SHARD = 2 << 20
HOT = 4096

_LOW = np.uint64((1 << 20) - 1)
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, np.int64).astype(np.uint64) | np.uint64(1)


def gram_hashes(text: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the gram bytes from each place (gram is a power of two), by doubling."""
    h, size, factor = _BYTES[text], 1, 0x9E3779B97F4A7C15
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor, size = factor * factor % (1 << 64), size * 2
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each width neighbours."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def segments(text: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int = SIZE, gram: int = GRAM):
    """Of the texts text[begin:end], at most CHUNK bytes in all: first and last window, and anchor's hash, of each segment, and whose it is."""
    if len(text) < size:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    h = gram_hashes(text, gram)
    key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_least(key, size - gram + 1) & _LOW).astype(np.int64)
    long = end - begin >= size
    owner = np.flatnonzero(long)
    first, last = begin[long], end[long] - size
    mark = np.zeros(len(anchor) + 1, np.int64)
    np.add.at(mark, first, 1)
    np.add.at(mark, last + 1, -1)
    valid = np.cumsum(mark[:-1]) > 0
    change = np.ones(len(anchor), bool)
    change[1:] = anchor[1:] != anchor[:-1]
    change[first] = True
    start = np.flatnonzero(change & valid)
    whose = np.searchsorted(first, start, side="right") - 1
    stop = np.minimum(np.append(start[1:], len(anchor)) - 1, last[whose])
    return start, stop, h[anchor[start]], owner[whose]


def _chunks(texts: list[bytes], size: int = SIZE):
    """Texts side by side in arrays of at most CHUNK bytes: the array, begin and end of each part, its text's number and place in it."""
    parts, used = [], 0
    for k, t in enumerate(texts):
        step = CHUNK - size + 1
        for at in range(0, max(1, len(t) - size + 1), step):
            part = t[at : at + CHUNK]
            if used + len(part) > CHUNK and parts:
                yield parts
                parts, used = [], 0
            parts.append((k, at, part))
            used += len(part)
    if parts:
        yield parts


def _scan(key_type: pa.DataType):
    from xxhash import xxh64_intdigest

    def run(batches):
        for batch in sliced(batches):
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            for parts in _chunks(texts):
                raw = b"".join(p for _, _, p in parts)
                end = np.cumsum([len(p) for _, _, p in parts])
                begin = end - np.array([len(p) for _, _, p in parts])
                start, stop, h, part = segments(np.frombuffer(raw, np.uint8), begin, end)
                if not len(start):
                    continue
                text = np.array([k for k, _, _ in parts])[part]
                base = np.array([at for _, at, _ in parts])[part] - begin[part]
                content = np.fromiter((xxh64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), (stop + SIZE).tolist(), strict=True)), np.uint64, len(start))
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array((start + base).astype(np.int64)), pa.array((stop - start + SIZE).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(content.view(np.int64))],
                    names=["d", "t", "at", "n", "anchor", "content"],
                )

    return run


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("d"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))


def _fetch(keyed: DataFrame, spots: DataFrame, kind: str) -> DataFrame:
    """The bytes of spots (d, t, wanted: at, n, shard, times, hot)."""
    s = spots.select(F.col("d").alias("sd"), F.col("t").alias("st"), "wanted").hint("shuffle_hash")
    joined = keyed.join(s, keyed["d"].eqNullSafe(s["sd"]) & (keyed["t"] == s["st"])).select("d", "t", "text", "wanted")

    def run(batches):
        for batch in sliced(batches):
            texts, wanted = batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()
            for lo in range(0, len(texts), 32):
                found = [(k, w, texts[k][w["at"] : w["at"] + w["n"]]) for k in range(lo, min(lo + 32, len(texts))) for w in wanted[k]]
                rows = pa.array([k for k, _, _ in found], pa.int64())
                columns = [pa.array([w[name] for _, w, _ in found], t) for name, t in (("at", pa.int64()), ("shard", pa.int64()), ("times", pa.int64()), ("hot", pa.bool_()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *columns, pa.array([p for _, _, p in found], pa.binary())], names=["d", "t", "at", "shard", "times", "hot", "piece"])

    return joined.mapInArrow(run, f"d {kind}, t long, at long, shard long, times long, hot boolean, piece binary")


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _in_shard(table: pa.Table) -> pa.Table:
    """Spans of the pieces that stand once, where their windows stand elsewhere in the shard."""
    pieces = table["piece"].to_pylist()
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)
    flags = suffixes.repeated(text, SIZE)
    size = np.array([len(p) + 1 for p in pieces])
    begin = np.cumsum(size) - size
    single = table["times"].to_numpy() == 1
    first, stop = _stretches(flags)
    whose = np.searchsorted(begin, first, side="right") - 1
    keep = single[whose]
    first, stop, whose = first[keep] - begin[whose[keep]], stop[keep] - begin[whose[keep]], whose[keep]
    at = table["at"].to_numpy()[whose]
    rows = pa.array(whose)
    return pa.table({"d": table["d"].take(rows), "t": table["t"].take(rows), "s": at + first, "e": at + stop - 1 + SIZE}).cast(
        pa.schema([("d", table.schema.field("d").type), ("t", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])
    )


def _windows(pieces: DataFrame, kind: str) -> DataFrame:
    """Spans of the hot pieces that stand once, by counting the hashes of their windows."""

    def run(batches):
        from xxhash import xxh3_128_digest

        for batch in sliced(batches):
            for k, piece in enumerate(batch.column(6).to_pylist()):
                n = len(piece) - SIZE + 1
                codes = np.frombuffer(b"".join(xxh3_128_digest(piece[p : p + SIZE]) for p in range(n)), np.int64).reshape(-1, 2)
                rows = pa.array(np.full(n, k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(4).take(rows), pa.array(batch.column(2)[k].as_py() + np.arange(n)), pa.array(codes[:, 0].copy()), pa.array(codes[:, 1].copy())],
                    names=["d", "t", "times", "s", "a", "b"],
                )

    rows = written(pieces.where("hot").mapInArrow(run, f"d {kind}, t long, times long, s long, a long, b long"))
    again = rows.groupBy("a", "b").agg(F.sum("times").alias("all")).where("all > 1").select("a", "b")
    return rows.where("times = 1").join(again, ["a", "b"], "left_semi").select("d", "t", "s", (F.col("s") + SIZE).alias("e"))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """d (key), t (hash of the text), s, e: bytes that go, in spans that may overlap."""
    bounded(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    keyed = _keyed(docs, key, text)
    found = written(keyed.mapInArrow(_scan(None), f"d {kind}, t long, at long, n int, anchor long, content long"))
    # written first, so that the join's sides are both shuffled as they are and a hot anchor's rows can be split
    anchors = written(found.groupBy("anchor").agg(F.count("*").alias("times"), F.min("content").alias("a"), F.max("content").alias("b")).where("times > 1").select("anchor", "a", "b"))
    met = written(found.join(anchors, "anchor").select("d", "t", "at", "n", "anchor", "content", (F.col("a") == F.col("b")).alias("alike")))
    place = ["d", "t", F.col("at").alias("s"), (F.col("at") + F.col("n")).alias("e")]
    unlike = met.where("not alike")
    kinds = written(unlike.groupBy("anchor", "content").agg(F.count("*").alias("times"), F.min(F.struct("d", "t", "at", "n")).alias("one")))
    whole = met.where("alike").select(*place).unionByName(unlike.join(kinds.where("times > 1").select("anchor", "content"), ["anchor", "content"], "left_semi").select(*place))

    open_ = written(kinds.groupBy("anchor").agg(F.min("times").alias("least"), F.count("*").alias("kinds")).where("least = 1").select("anchor", "kinds"))
    wanted = kinds.join(open_, "anchor").select("anchor", "times", (F.col("kinds") > HOT).alias("hot"), "one.*")
    size = wanted.agg(F.sum("n")).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(size // SHARD + 1)).alias("shard")
    spots = wanted.select("d", "t", F.struct("at", "n", shard, "times", "hot").alias("w")).groupBy("d", "t").agg(F.collect_list("w").alias("wanted"))
    pieces = written(_fetch(keyed, spots, kind))
    shards = pieces.where("not hot").groupBy("shard").applyInArrow(_in_shard, f"d {kind}, t long, s long, e long")
    return whole.unionByName(shards).unionByName(_windows(pieces, kind))


def merged(found: list[dict] | None) -> list[tuple[int, int]]:
    """Spans that neither overlap nor touch."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in found or ()):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, removed (spans of bytes: s, e) and kept (the remaining bytes) of each row."""
    found = spans(docs, key, text).groupBy("d", "t").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    keyed, kind = _keyed(docs, key, text), docs.schema[key].dataType.simpleString()
    f = found.select(F.col("d").alias("sd"), F.col("t").alias("st"), "spans").hint("shuffle_hash")
    joined = keyed.join(f, keyed["d"].eqNullSafe(f["sd"]) & (keyed["t"] == f["st"]), "left").select("d", "text", "spans")

    def run(batches):
        for batch in sliced(batches):
            size, gone, kept = [], [], []
            for t, s in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                t, s = t or b"", merged(s)
                size.append(len(t))
                gone.append([{"s": a, "e": b} for a, b in s])
                kept.append(b"".join(t[a:b] for a, b in zip([0, *(e for _, e in s)], [*(a for a, _ in s), len(t)], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array(kept, pa.binary())], names=["key", "n_bytes", "removed", "kept"]
            )

    out = joined.mapInArrow(run, f"key {kind}, n_bytes long, removed array<struct<s:long,e:long>>, kept binary")
    return out.withColumnRenamed("key", key)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and SHA-256 of the remaining bytes."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return remove(docs).select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
