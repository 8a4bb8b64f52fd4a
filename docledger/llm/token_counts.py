"""Token counts: additive totals by source, language and tokenizer version, kept up by signed batches.

A batch holds changes: an insert adds a document and its tokens, a delete takes both away, a revision moves the tokens by
the difference of a new count and the old one. A batch is summed by group before it is stored, as one folder
named by its id; storing is a rename that fails if the name is taken, so a batch is there whole or not at all, of racing commits of one id one counts, and
a batch whose id is there already changes nothing. Totals are sums over batches. compact() puts many batches into one: it writes their sums, then, by one such
rename, a snapshot that names the sums and the batches in them. Readers take the last snapshot and the batches it does not name, so they see the totals of before or
after, a crash leaves either, and a batch stored meanwhile counts. Renames are atomic as far as the file system's are; commits of one process take turns.

Null text counts no tokens; a null source, language or version is a group of its own; groups whose documents and tokens come
to nothing are left out. Repeated rows are counted as often as they stand. A retry of a failed commit needs no clean-up.
"""

from __future__ import annotations

import json
import threading
import uuid
from urllib.parse import quote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.lineage import shared_dir, written
from docledger.llm import bpe
from docledger.llm.common import bounded, sliced

GROUP = ("source", "lang", "version")
CHANGE = "source string, lang string, version string, docs long, tokens long"

#: The version of a counting rule: what stands between ASCII white space is a token.
WORDS = "words-1"
#: The version of the tokenizer file word_bpe_49k.json.
BPE = "word-bpe-49k"


def words(text: str | None) -> int:
    """Number of tokens of the counting rule."""
    return len((text or "").encode("utf-8", "surrogatepass").split())


def counts(docs: DataFrame, path: str, key: str) -> DataFrame:
    """key, words (of the counting rule) and n_tokens (of the tokenizer file at path) of each row, in one pass over the texts."""
    bounded(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        codec = bpe.Codec(path, True)
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            tokens = pa.array([len(x) // 4 for x in codec.encode_all(texts)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([words(x) for x in texts], pa.int64()), tokens], names=["key", "words", "n_tokens"])

    return docs.select(docs[key].alias("key"), docs["text"]).mapInArrow(run, f"key {kind}, words long, n_tokens long").withColumnRenamed("key", key)


def bpe_counts(docs: DataFrame, path: str, key: str = "doc_id", *, split_space: bool = True) -> DataFrame:
    """key and n_tokens by the tokenizer file at path."""
    return bpe.encode(docs, path, key, split_space=split_space, decoded=False).select(key, "n_tokens")


def inserted(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return rows.select(*GROUP, F.lit(1).cast("long").alias("docs"), F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("tokens"))


def deleted(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return rows.select(*GROUP, F.lit(-1).cast("long").alias("docs"), (-F.coalesce(F.col(tokens), F.lit(0))).cast("long").alias("tokens"))


def revised(rows: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    return rows.select(*GROUP, F.lit(0).cast("long").alias("docs"), (F.coalesce(F.col(new), F.lit(0)) - F.coalesce(F.col(old), F.lit(0))).cast("long").alias("tokens"))


_TURN = threading.Lock()


class Rollup:
    """Totals in a folder of any file system that Spark writes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._path, conf = self._hadoop.Path, spark._jsc.hadoopConfiguration()
        top = self._path(self.folder)
        self._fs = top.getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), conf)

    def _names(self, kind: str) -> list[str]:
        top = self._path(f"{self.folder}/{kind}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(top)) if self._fs.exists(top) else []

    def _placed(self, pending: str, kind: str, name: str) -> bool:
        """Rename a folder to a name that is free. False if it is taken: the folder goes."""
        self._fs.mkdirs(self._path(f"{self.folder}/{kind}"))
        none = self.spark._sc._gateway.new_array(self._hadoop.Options.Rename, 0)
        with _TURN:
            try:
                if not self._fs.exists(self._path(f"{self.folder}/{kind}/{name}")):
                    self._context.rename(self._path(pending), self._path(f"{self.folder}/{kind}/{name}"), none)
                    return True
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" not in str(e.java_exception):
                    raise
        self._fs.delete(self._path(pending), True)
        return False

    def _snapshot(self) -> tuple[int, str | None, list[str]]:
        """Number of the last snapshot, the folder of its sums, and the names of the batches in them."""
        found = self._names("snapshots")
        if not found:
            return 0, None, []
        rows = self.spark.read.text(f"{self.folder}/snapshots/{found[-1]}").collect()  # one row
        kept = json.loads(rows[0].value)
        return int(found[-1]), kept["sums"], kept["batches"]

    def batches(self) -> list[str]:
        """The ids, as file names, of all batches stored."""
        return sorted({*self._names("batches"), *self._snapshot()[2]})

    def committed(self, batch: str) -> bool:
        return quote(batch, safe="") in self.batches()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes (CHANGE). False if a batch of that id has been added before."""
        if self.committed(batch):
            return False
        pending = f"{self.folder}/pending/{uuid.uuid4().hex}"
        _summed(changes).write.parquet(pending)
        return self._placed(pending, "batches", quote(batch, safe=""))

    def _read(self) -> list[str]:
        """The folders whose sum is the totals."""
        _, sums, inside = self._snapshot()
        return [sums] * (sums is not None) + [f"{self.folder}/batches/{n}" for n in self._names("batches") if n not in set(inside)]

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens of all batches."""
        found = self._read()
        return _summed(self.spark.read.schema(CHANGE).parquet(*found) if found else self.spark.createDataFrame([], CHANGE))

    def compact(self) -> bool:
        """Put all batches into one. False if another compaction came first, or there is nothing to do. Batches stay where they are: vacuum() takes them away."""
        number, sums, inside = self._snapshot()
        more = [n for n in self._names("batches") if n not in set(inside)]
        if not more:
            return False
        into = f"{self.folder}/sums/{uuid.uuid4().hex}"
        found = [sums] * (sums is not None) + [f"{self.folder}/batches/{n}" for n in more]
        _summed(self.spark.read.schema(CHANGE).parquet(*found)).write.parquet(into)
        pending = f"{self.folder}/pending/{uuid.uuid4().hex}"
        self.spark.createDataFrame([(json.dumps({"sums": into, "batches": sorted([*inside, *more])}),)], "value string").coalesce(1).write.text(pending)
        if self._placed(pending, "snapshots", f"{number + 1:012d}"):
            return True
        self._fs.delete(self._path(into), True)
        return False

    def vacuum(self) -> None:
        """Take away the folders of batches that the last snapshot has summed. Not while a reader may still hold an older snapshot; a batch's id stays taken."""
        for n in set(self._snapshot()[2]) & set(self._names("batches")):
            self._fs.delete(self._path(f"{self.folder}/batches/{n}"), True)


def _summed(changes: DataFrame) -> DataFrame:
    out = changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return out.where("docs != 0 or tokens != 0")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Totals after three batches over all of docs, each committed twice. path: the tokenizer's file.

    All documents are inserted, with the words of the counting rule as tokens of either version. Of documents with equal texts all but the one with the smallest id
    (one without an id only where there is no other) are deleted. Then the tokenizer's version is revised to what the tokenizer counts.
    """
    spark = docs.sparkSession
    known = F.struct("doc_id", "source", "lang", F.xxhash64("text").alias("h"), F.xxhash64(F.lit("again"), "text").alias("g"))
    counted = written(counts(docs.select(known.alias("row"), "text"), path, "row"))
    rows = counted.select("row.source", "row.lang", F.col("words").alias("tokens"))
    first = F.min(F.struct(F.col("row.doc_id").isNull().alias("nameless"), F.col("row.doc_id").alias("id"), "row.source", "row.lang", "words", "n_tokens")).alias("first")
    stays = written(counted.groupBy("row.h", "row.g").agg(first).select("first.source", "first.lang", F.col("first.words").alias("tokens"), "first.n_tokens"))

    def both(part: DataFrame) -> DataFrame:
        return part.select("source", "lang", F.explode(F.array(F.lit(WORDS), F.lit(BPE))).alias("version"), "tokens")

    rollup = Rollup(spark, f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}")
    changes = {
        "load": inserted(both(rows)),
        # all but those that stay: all are taken away, and those that stay are put back
        "withdraw": deleted(both(rows)).unionByName(inserted(both(stays.drop("n_tokens")))),
        "recount": revised(stays.withColumn("version", F.lit(BPE)), "tokens", "n_tokens"),
    }
    for batch, change in [*changes.items(), *changes.items()]:
        rollup.commit(batch, change)
    rollup.compact()
    return rollup.totals()
