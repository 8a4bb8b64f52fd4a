"""Ledgers of nodes made from plain tables: the same rows that document packages are parsed into.

A ledger row is a node: doc (its document), seq (pre-order, from 0), parent_seq, kind, and facts of the kind. Every
document's rows come from one row of the source, so no ledger needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger import ids

PART = "word/document.xml"
BODY = "/w:document/w:body[1]"


def document_lines(documents: DataFrame) -> DataFrame:
    """doc_id, pos (from 1), line: the lines of each text; null text has none."""
    return documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).select("doc_id", (F.col("at") + 1).alias("pos"), "line")


def documents(docs: DataFrame) -> DataFrame:
    """A body node for each document, a paragraph and a text run for each line."""
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    lines = F.coalesce(F.split("text", "\n"), F.array().cast("array<string>"))

    def node(seq, parent, sibling, kind, path, text):
        return F.struct(seq.cast("long").alias("seq"), parent.cast("long").alias("parent_seq"), sibling.cast("long").alias("sibling_index"), F.lit(kind).alias("kind"), path.alias("xml_path"), text.alias("text"))

    def paragraph(i):
        return F.concat(F.lit(f"{BODY}/w:p["), (i + 1).cast("string"), F.lit("]"))

    none = F.lit(None).cast("string")
    body = F.array(node(F.lit(0), F.lit(None), F.lit(0), "document_body", F.lit(BODY), none))
    pairs = F.flatten(F.transform(lines, lambda line, i: F.array(node(2 * i + 1, F.lit(0), i, "paragraph", paragraph(i), none), node(2 * i + 2, 2 * i + 1, F.lit(0), "text_run", F.concat(paragraph(i), F.lit("/w:r[1]")), line))))
    rows = docs.select("doc_id", name.alias("doc"), F.explode(F.concat(body, pairs)).alias("n")).select("doc_id", "doc", "n.*")
    return rows.withColumn("node_id", ids.node_id(F.col("doc"), PART, F.col("xml_path"), F.col("kind")))


def conversations(turns: DataFrame) -> DataFrame:
    """A paragraph for each turn; user turns are headings of level 1, system turns of level 2, assistant turns are numbered."""
    return turns.select(
        F.col("conv_id").alias("doc"), F.col("turn").alias("seq"), F.lit("paragraph").alias("kind"), "role", F.col("text"),
        F.when(F.col("role") == "user", 0).when(F.col("role") == "system", 1).alias("outline_level"),
        F.when(F.col("role") == "assistant", F.lit("1")).alias("num_id"),
        (F.length("text") % 4).cast("int").alias("list_level"),
    )
