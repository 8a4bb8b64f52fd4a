"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python worker turns into results at once: texts may be long, and two workers share an executor's memory.
BATCH_ROWS = 256
#: Most bytes of a batch on its way to a Python worker.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(spark: SparkSession) -> None:
    """Let no Arrow batch of the session be larger than BATCH_BYTES: two tasks of an executor hold several at once. The same for all operators, and a smaller bound stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:  # a size may have a unit
        spark.conf.set(name, str(BATCH_BYTES))


def _tidied() -> None:
    """Give memory that is free back to the system: workers stay for later tasks, beside those of other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def sliced(batches, rows: int = BATCH_ROWS):
    """Arrow batches, which Spark bounds in bytes, in slices of few rows: what is made of one at a time, and sent back, is bounded too."""
    _tidied()
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
    _tidied()


def ascii_lower(column):
    """Lower-case A-Z alone, whatever the locale or the script."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of docs, all columns, of each component: of the smallest id, then of the smallest hash of the text; a row without an id only where there is no other.

    found: doc_id, t (XXH64 of the text) and component of each row of docs. Rows are told apart by id and text, so texts that share an id have each their own fate.
    """
    found = found.select(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "t").alias("row"), "component")
    first = found.groupBy("component").agg(F.min("row").alias("first"))
    more = found.join(first, "component").where("row != first").select(F.col("row.doc_id").alias("d"), F.col("row.t").alias("h")).distinct()
    own = "t"
    while own.lower() in (c.lower() for c in docs.columns):
        own += "_"
    marked = docs.withColumn(own, F.xxhash64("text"))
    kept = marked.join(more, marked["doc_id"].eqNullSafe(more["d"]) & (marked[own] == more["h"]), "left_anti")
    twice = found.groupBy("row").count().where("count > 1").select(F.col("row.doc_id").alias("d"), F.col("row.t").alias("h"))
    if not twice.isEmpty():
        same = kept["doc_id"].eqNullSafe(twice["d"]) & (kept[own] == twice["h"])
        kept = kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", own]))
    return kept.select(docs.columns)
