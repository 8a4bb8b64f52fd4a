"""Toxicity by compression distance: what two zstandard dictionaries save on each window of a text.

Both dictionaries begin with the same ordinary text. The toxic one goes on with stretches that labelled toxic texts
share and ordinary ones lack. (Dictionaries that zstandard trains on either class alone hold mostly what both classes share, and
differ by chance: their distances tell the classes apart with an area under the curve of 0.56 to 0.68 at sf0.1, these with 0.94.) A window is some 32 bytes of whole words; its distance is the bytes by which the toxic
dictionary compresses it better, at the two LEVELS together. The distances of all windows of a text give six figures (FEATURES), and a logistic
curve over them, calibrated on labelled texts that chose no dictionary, gives the score.

Fitting reads at most PER_CLASS labelled texts of each class, the ones with the smallest hash of the id, none longer
than LONGEST characters, of rows that share an id the smallest text; it happens on the driver within that bound. Scoring reads every text whole. Inputs of a
score are the text alone. Null text is empty; a text without words has no windows and scores 0. With no labelled
text of one of the classes, every score is the smoothed share of toxic labels. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.common import bounded, sliced

#: Most labelled texts of each class that are read to fit.
PER_CLASS = 3000
#: Longest text that is read to fit, in characters.
LONGEST = 20_000
#: Bytes of ordinary text in either dictionary, and most bytes of toxic stretches.
BASE, TAIL = 16_384, 16_384
#: Levels of compression whose distances are added up: each has its own way to look for matches, and so its own errors.
LEVELS = (3, 4)
THRESHOLD = 0.7
#: Share of the weight that toxic texts have in the calibration, whatever share of the sample they are.
SHARE = 0.2
#: Length of the stretches that are counted, in bytes, and how much more frequent they must be in toxic texts.
GRAM, RATIO, SIGMAS, LEAST = 8, 3.0, 5.0, 4

FEATURES = ("largest distance", "mean of the three largest", "mean gain", "share of windows from 3", "log of windows from 3", "log of windows")

_BREAK = re.compile(r"[\W\d_]+")
_WINDOW = re.compile(rb"\S[\x00-\xff]{0,31}\S{0,48}")


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    mean: list
    scale: list
    weights: list
    prior: float


def words_of(text: str | None) -> bytes:
    return _BREAK.sub(" ", (text or "").lower()).strip().encode()


class Distance:
    """Compresses windows with both dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.by = [(self._compressor(ordinary, level), self._compressor(toxic, level)) for level in LEVELS]

    @staticmethod
    def _compressor(content: bytes, level: int):
        import zstandard

        book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        book.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=book, write_content_size=False, write_dict_id=False, write_checksum=False)

    def features(self, words: bytes) -> list[float]:
        by = [(o.compress, t.compress) for o, t in self.by]
        found: Counter = Counter()
        for m in _WINDOW.finditer(words):
            window = b" " + m[0]
            found[sum(len(o(window)) - len(t(window)) for o, t in by)] += 1
        n = sum(found.values())
        if not n:
            return [0.0] * len(FEATURES)
        top = [d for d in sorted(found, reverse=True)[:3] for _ in range(min(3, found[d]))][:3]
        some = sum(c for d, c in found.items() if d >= 3)
        gain = sum(max(d, 0) * c for d, c in found.items())
        return [float(top[0]), sum(top) / len(top), gain / n, some / n, math.log1p(some), math.log1p(n)]


def grams(word: bytes) -> list[bytes]:
    return [word[k : k + GRAM] for k in range(max(1, len(word) - GRAM + 1))]


def unlike(rows: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """One row of those whose words share the two smallest hashes: copies would count as evidence many times."""
    kept = {}
    for words, y in rows:
        kept.setdefault((y, *sorted({zlib.crc32(w) for w in words.split()})[:2]), (words, y))
    return list(kept.values())


def stretches(texts: list[tuple[bytes, int]]) -> list[bytes]:
    """Parts of words that toxic texts share and ordinary ones lack, the most frequent last."""
    seen, size = (Counter(), Counter()), [0, 0]
    for words, toxic in texts:
        size[toxic] += 1
        seen[toxic].update({g for w in set(words.split()) for g in grams(b" " + w)})
    hot = set()
    for g, c in seen[1].items():
        if c >= LEAST:
            o = seen[0][g]
            p = (c + o) / (size[0] + size[1])
            sigma = math.sqrt(p * (1 - p) * (1 / size[0] + 1 / size[1])) or 1e-9
            if (c + 0.5) / (size[1] + 1) >= RATIO * (o + 0.5) / (size[0] + 1) and c / size[1] - o / size[0] >= SIGMAS * sigma:
                hot.add(g)
    found: Counter = Counter()
    for words, toxic in texts:
        for w in words.split() if toxic else ():
            w = b" " + w
            run = 0
            for k, g in enumerate([*grams(w), b""]):
                if g in hot:
                    run += 1
                elif run:
                    found[w[k - run : k - 1 + GRAM]] += 1
                    run = 0
    return [s for s, _ in sorted(found.items(), key=lambda x: (x[1], x[0]))]


def fit_texts(texts: list[tuple[str, int]]) -> Model:
    """A model of labelled texts; the same texts in the same order give the same model."""
    size = [sum(1 for _, y in texts if y == k) for k in (0, 1)]
    prior = (size[1] + 0.5) / (sum(size) + 1)
    if not all(size):
        return Model(b"", b"", [], [], [], prior)
    rows = unlike([(words_of(t), y) for t, y in texts])
    by_class = [[r for r in rows if r[1] == k] for k in (0, 1)]
    choose = [r for part in by_class for k, r in enumerate(part) if k % 3 or len(part) < 3]
    calibrate = [r for part in by_class for k, r in enumerate(part) if not k % 3 or len(part) < 3]
    ordinary = [w for w, y in choose if not y]
    random.Random(0).shuffle(ordinary)
    base = b" ".join(w[:2048] for w in ordinary)[:BASE] + b" " * 9
    tail = b"".join(stretches(choose))[-TAIL:]
    distance = Distance(base, base[:-9] + tail + b" " * 9)
    x = np.array([distance.features(w) for w, _ in calibrate])
    y = np.array([k for _, k in calibrate], float)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    share = np.where(y == 1, SHARE / max(y.mean(), 1e-9), (1 - SHARE) / max(1 - y.mean(), 1e-9))
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (share * p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(w))
        w -= np.linalg.solve(h, z.T @ (share * (p - y)) + 0.05 * w)
    return Model(base, base[:-9] + tail + b" " * 9, mean.tolist(), scale.tolist(), w.tolist(), prior)


def held_out(key: str = "doc_id"):
    """Whether a row is kept from fitting: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", per_class: int = PER_CLASS) -> Model:
    """A model of labelled rows that are not held out, at most per_class of each class."""
    usable = labels.select(F.col(key).alias("k"), F.col("toxic").alias("y")).where(F.col("k").isNotNull() & F.col("y").isin(0, 1) & ~held_out("k"))
    chosen: dict = {}
    for y in (0, 1):
        for r in usable.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(per_class).collect():
            chosen[r.k] = y
    if not chosen:
        return fit_texts([])
    picked = docs.sparkSession.createDataFrame(sorted(chosen.items()), f"k {labels.schema[key].dataType.simpleString()}, y int")
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.length("t") <= LONGEST)
    found = {r.k: (r.t, r.y) for r in rows.join(F.broadcast(picked), "k").groupBy("k", "y").agg(F.min("t").alias("t")).collect()}  # 2 * per_class rows of LONGEST characters at most
    order = sorted(found, key=lambda k: (zlib.crc32(str(k).encode() + b"fit"), str(k)))
    return fit_texts([found[k] for k in order])


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.distance = Distance(model.ordinary, model.toxic) if model.weights else None

    def score(self, text: str | None) -> float:
        m = self.model
        if self.distance is None:
            return m.prior
        f = self.distance.features(words_of(text))
        if not f[-1]:
            return 0.0
        total = m.weights[-1] + sum(w * (v - a) / s for w, v, a, s in zip(m.weights, f, m.mean, m.scale, strict=False))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", into: str = "score") -> DataFrame:
    """key and the score of each row's whole text."""
    bounded(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        scorer = Scorer(model)
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer.score(t) for t in batch.column(1).to_pylist()], pa.float64())], names=["key", "score"])

    out = docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, f"key {kind}, score double")
    return out.select(F.col("key").alias(key), F.col("score").alias(into))


def keep_ordinary(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns, whose text scores below threshold."""
    bounded(docs.sparkSession)
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        scorer = Scorer(model)
        for batch in sliced(batches):
            yield batch.filter(pa.array([scorer.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
