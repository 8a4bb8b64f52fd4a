"""BPE encoding and decoding with a public tokenizer file, by tree concatenation.

A text is taken as unsplit: its halves, quarters and so on down to LEAF characters, cut wherever the middle falls, are leaves. The leaves of many
texts are encoded in parallel, THREADS at a time, as one batch; then they are joined pairwise, up to the whole text. At a join a window around the cut is
encoded again and grows until it agrees with both sides: a *run* (what stands between white space) other than the outermost one must have
the same tokens in the window and in the side, on the left and on the right, or the window must reach the side's end. Between runs the tokenizer
itself cuts (``split_space``), so what lies beyond an agreeing run does not change. A leaf's runs are looked up among those that a worker has met.

A run of more than LEAF characters, and a whole text where the tokenizer does not cut at white space, has no such places. Its own halves go the same
way by tokens: at some place on the left, and one on the right, the window and the side must hold the same two
neighbouring tokens, over the same characters, with the same word boundary between them. Words are cut by a rule that only looks ahead three characters, so equal cuts stay
equal. Within a word, merges happen in the order of their ranks, so a sequence of tokens is the encoding of its
text if each two neighbours are the encoding of theirs: the first merge across a boundary would also happen in the
pair alone. Every pair in the result stands in the encoding of a side or of the window.

Null text is empty; an empty text has no tokens and decodes to an empty text. A row of the input is a row of the
result, whatever its id. Memory: texts of CHARS characters or one longer one, their tokens, and a cache of at most CACHE short runs.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docledger.llm.common import bounded, sliced

#: Most characters of a leaf, of a text and of a run within it.
LEAF = 2048
#: Threads that encode the leaves of a batch.
THREADS = 2
#: Characters of texts whose leaves make up a batch.
CHARS = 1 << 20
#: Characters on either side of a cut that are encoded again first.
REACH = 24
#: Short runs whose tokens are remembered in a worker.
CACHE = 300_000
#: The white space of Unicode.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_LAST_SPACE = re.compile(f"(?s:.*){SPACE.pattern[:-1]}")
#: What str.split() takes for white space besides.
NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


class Piece:
    """Tokens of text[lo:hi]: ids, first and last character, and whether a token begins a word."""

    def __init__(self, lo: int, hi: int, ids, start, end, first):
        self.lo, self.hi, self.ids, self.start, self.end, self.first = lo, hi, ids, start, end, first

    @staticmethod
    def of(encoding, lo: int, hi: int) -> Piece:
        words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
        spans = np.array(encoding.offsets, np.int64).reshape(-1, 2) + lo
        first = np.ones(len(words), bool)
        first[1:] = words[1:] != words[:-1]
        return Piece(lo, hi, np.array(encoding.ids, np.uint32), spans[:, 0], spans[:, 1], first)

    def pairs(self, begin: int, end: int) -> Iterator[tuple[tuple, int]]:
        """Neighbours whose second token is one of begin to end: what identifies them, and the second one's place."""
        for k in range(max(1, begin), min(end, len(self.ids))):
            if self.end[k - 1] <= self.start[k]:
                yield (int(self.ids[k - 1]), int(self.ids[k]), int(self.start[k - 1]), int(self.end[k - 1]), int(self.start[k]), int(self.end[k]), bool(self.first[k])), k


class Codec:
    """Encodes and decodes as the tokenizers library does with the file at path, without added special tokens."""

    def __init__(self, path: str, split_space: bool, leaf: int = LEAF):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        from tokenizers import Tokenizer, normalizers

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self._bare, self._plain = None, lambda: normalizers.Sequence([])
        self.split_space, self.leaf, self.cache = split_space, leaf, {}
        added = sorted((t.content for t in self.whole.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.words = [self.whole.id_to_token(k) for k in range(self.whole.get_vocab_size())]

    @property
    def bare(self):
        """The tokenizer without its normalizer, made when it is first needed."""
        if self._bare is None:
            self._bare = type(self.whole).from_str(self.whole.to_str())
            self._bare.normalizer = self._plain()
        return self._bare

    # long unsplit runs

    def _leaves(self, lo: int, hi: int) -> list[tuple[int, int]]:
        if hi - lo <= self.leaf:
            return [(lo, hi)]
        mid = (lo + hi) // 2
        return self._leaves(lo, mid) + self._leaves(mid, hi)

    def _tree(self, text: str) -> Piece:
        """Tokens of a normalised run."""
        cuts = self._leaves(0, len(text))
        pieces = [Piece.of(e, lo, hi) for (lo, hi), e in zip(cuts, self.bare.encode_batch([text[lo:hi] for lo, hi in cuts], add_special_tokens=False), strict=True)]
        while len(pieces) > 1:  # halves have equal depth but for one level, so neighbours are joined level by level
            pieces = [self._join(text, *pieces[k : k + 2]) if k + 1 < len(pieces) else pieces[k] for k in range(0, len(pieces), 2)]
        return pieces[0]

    def _join(self, text: str, left: Piece, right: Piece) -> Piece:
        cut, reach = right.lo, 16
        while True:
            k = max(0, len(left.ids) - reach)
            lo = int(left.start[k]) if k else left.lo
            j = min(len(right.ids), reach)
            hi = int(right.end[j - 1]) if j < len(right.ids) else right.hi
            window = Piece.of(self.bare.encode(text[lo:hi], add_special_tokens=False), lo, hi)
            mine = dict(window.pairs(1, len(window.ids)))
            a = i = 0 if lo == left.lo else None
            if a is None:
                for key, place in left.pairs(k + 1, len(left.ids)):
                    if key[4] <= cut - 3 and key in mine:
                        i, a = place, mine[key]
                        break
            b, r = (len(window.ids), len(right.ids)) if hi == right.hi else (None, None)
            if b is None and a is not None:
                for key, place in right.pairs(1, j):
                    if key[4] <= hi - 3 and mine.get(key, -1) >= a:
                        r, b = place, mine[key]
            if a is not None and b is not None:
                parts = [(left, slice(0, i)), (window, slice(a, b)), (right, slice(r, None))]
                return Piece(left.lo, right.hi, *(np.concatenate([getattr(p, name)[at] for p, at in parts]) for name in ("ids", "start", "end", "first")))
            reach *= 2

    def _run(self, text: str) -> bytes:
        """Ids of a run of any length. Added tokens are found first, in the text as it is."""
        out, at = [], 0
        for m in [*(self.added.finditer(text) if self.added else ()), None]:
            rest = text[at : m.start() if m else len(text)]
            if rest:
                if self.whole.normalizer is not None:
                    rest = self.whole.normalizer.normalize_str(rest)
                out.append(self._tree(rest).ids.astype("<u4").tobytes())
            if m:
                out.append(int(self.whole.token_to_id(m[0])).to_bytes(4, "little"))
                at = m.end()
        return b"".join(out)

    # texts

    def _runs(self, text: str) -> list[str]:
        if not self.split_space:
            return [text] if text else []
        if any(c in text for c in NOT_SPACE):
            return [x for x in SPACE.split(text) if x]
        return text.split()

    def _cuts(self, text: str, lo: int, hi: int) -> list[int]:
        """Where the leaves of text[lo:hi] end. A run of more than a leaf is a leaf of its own."""
        if hi - lo <= self.leaf or not self.split_space:
            return [hi]
        mid = (lo + hi) // 2
        after, before = SPACE.search(text, mid, min(hi, mid + self.leaf)), _LAST_SPACE.match(text, max(lo, mid - self.leaf), mid)
        if not after or not before:  # not within a run of that length
            after = after or (None if before else SPACE.search(text, mid, hi))
            before = before or _LAST_SPACE.match(text, lo, mid)
            if not after and not before:
                return [hi]
            mid = after.start() if after else before.end()
        return self._cuts(text, lo, mid) + self._cuts(text, mid, hi)

    def _tokens(self, runs: list[str]) -> list[bytes]:
        """Ids of each run; those not met before are encoded as one batch."""
        missing = [r for r in dict.fromkeys(runs) if r not in self.cache]
        short = [r for r in missing if len(r) <= self.leaf]
        for run, e in zip(short, self.whole.encode_batch_fast(short, add_special_tokens=False), strict=True):
            self.cache[run] = array("I", e.ids).tobytes()
        if len(short) == len(missing):
            return [self.cache[r] for r in runs]
        long = {r: self._run(r) for r in missing if len(r) > self.leaf}
        return [self.cache[r] if r in self.cache else long[r] for r in runs]

    def _concatenated(self, text: str, left: list, right: list) -> list:
        """[first character, last character, ids of each run] of two neighbours, made of left. The window grows until it agrees with both."""
        lo, cut, hi, reach = left[0], left[1], right[1], REACH
        while True:
            a, b = max(lo, cut - reach), min(hi, cut + reach)
            before, after, window = self._runs(text[a:cut]), self._runs(text[cut:b]), self._runs(text[a:b])
            if (a == lo or len(before) > 2) and (b == hi or len(after) > 2):
                found = self._tokens(window)
                # the outermost runs may be parts of longer ones; the next ones must agree
                if (a == lo or found[1] == left[2][1 - len(before)]) and (b == hi or found[-2] == right[2][len(after) - 2]):
                    del left[2][len(left[2]) - len(before) + (a > lo) :]
                    left[2] += found[a > lo : len(found) - (b < hi)]
                    left[2] += right[2][len(after) - (b < hi) :]
                    left[1] = hi
                    return left
            reach *= 2

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        begin, used = 0, 0
        for k, t in enumerate(texts):
            if k > begin and used + len(t or "") > CHARS:
                yield from self._batch(texts[begin:k])
                begin, used = k, 0
            used += len(t or "")
        yield from self._batch(texts[begin:])

    def _batch(self, texts: list[str | None]) -> Iterator[bytes]:
        if len(self.cache) > CACHE:
            self.cache.clear()
        cuts = [self._cuts(t, 0, len(t)) if t else [] for t in texts]
        leaves = [[self._runs(t[a:b]) for a, b in zip([0, *c], c)] for t, c in zip(texts, cuts, strict=True)]  # noqa: B905
        found = self._tokens([r for text in leaves for leaf in text for r in leaf])
        at = 0
        for text, ends, runs in zip(texts, cuts, leaves, strict=True):
            parts, lo = [], 0
            for end, leaf in zip(ends, runs, strict=True):
                parts.append([lo, end, found[at : at + len(leaf)]])
                lo, at = end, at + len(leaf)
            while len(parts) > 1:
                parts = [self._concatenated(text, *parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
            yield b"".join(parts[0][2]) if parts else b""

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> str:
        """Text of such ids, special tokens included."""
        found = array("I", ids)
        if self.whole.decoder is None:
            return " ".join(map(self.words.__getitem__, found))
        return self.whole.decode(list(found), skip_special_tokens=False)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", *, split_space: bool = True, decoded: bool = True) -> DataFrame:
    """key, n_tokens, ids (binary, little-endian unsigned 32-bit integers) and, if asked for, the decoded text.

    split_space: the tokenizer of that file drops white space and never joins across it.
    """
    bounded(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        codec = Codec(path, split_space)
        for batch in sliced(batches):
            ids = list(codec.encode_all(batch.column(1).to_pylist()))
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            names = ["key", "n_tokens", "ids"]
            if decoded:
                columns.append(pa.array([codec.decode(x) for x in ids], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, f"key {kind}, n_tokens long, ids binary" + ", decoded string" * decoded)
    return out.withColumnRenamed("key", key)


def decode(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and the decoded text of ids; null ids are empty."""
    bounded(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        codec = Codec(path, True)
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([codec.decode(x or b"") for x in batch.column(1).to_pylist()], pa.string())], names=["key", "decoded"])

    return rows.select(rows[key].alias("key"), rows[ids].alias("ids")).mapInArrow(run, f"key {kind}, decoded string").withColumnRenamed("key", key)
