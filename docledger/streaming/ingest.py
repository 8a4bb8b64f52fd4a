"""Packages as they arrive: the same parse over a stream of files, each file once, each batch written once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from docledger.sources import packages

FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest(spark: SparkSession, path: str, folder: str, *, glob: str = "*.docx", files_per_batch: int = 100):
    """A query that parses new packages below path into folder/documents, a folder for each batch, and ends when all that is there is done."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).load(path)

    def write(batch, number: int) -> None:
        # a batch that is run again overwrites its own folder, so nothing is there twice
        packages.parse(batch).write.mode("overwrite").parquet(f"{folder}/documents/batch={number}")

    return files.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()


def documents(spark: SparkSession, folder: str):
    """What has been ingested; of a file that came more than once, the last."""
    rows = spark.read.parquet(f"{folder}/documents")
    last = rows.groupBy("doc").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["doc", "batch"]).drop("batch")
