"""Benchmark decontamination by winnowing, in DataFrame expressions alone.

Words: A-Z are lower-cased; a word is a run of digits, a-z and characters beyond ASCII. A window is SPAN = 8
consecutive words of an item; an item of fewer words, but not none, is one window. A document word is hit if it lies in
any occurrence of a window.

Winnowing: a k-gram is GRAM = 5 words, and of each SPAN - GRAM + 1 = 4 neighbouring k-grams the one with the smallest
hash (the last of equals) is kept as a fingerprint, once for all windows that choose it. The fingerprints of documents meet those of items in
one join. A window's words alone decide which fingerprint it chooses, so every shared span of SPAN words holds one that meets.
A meeting is extended to the windows of SPAN words around it, up to four, and those that equal an item's word by word are hits.
Items shorter than SPAN go the same way with windows of their own length, whose fingerprint is their smallest k-gram or, below GRAM words, the window.

Documents are read and taken apart once, without a shuffle; hits (one row for each document besides) are written to the shared folder and all sums
are made from these. Fingerprints and windows of the items are broadcast if they are at most BROADCAST bytes, else what documents keep
is shuffled: fingerprints with the few words around them.

Null text has no words. Repeated rows give repeated rows; rows that share an id but not the text are told apart.
A null id is a value like others; null item ids take no part.

contaminated says that windows of least_items items or more are found. With alone it also says that a window of SPAN words of any one item is
found. Items of fewer words, which any text may hold by chance, count by their number alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.lineage import written
from docledger.llm.common import ascii_lower

SPAN, GRAM = 8, 5
#: Most bytes of item windows, at BYTES each, that are sent to all executors.
BROADCAST = 64 << 20
BYTES = 192
#: What stands between words, A-Z being lower-cased before.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, none if it is null."""
    spaced = F.trim(F.regexp_replace(ascii_lower(text), GAP, " "))
    return F.when(F.length(spaced) > 0, F.split(spaced, " ")).otherwise(F.array().cast("array<string>"))


def _taken(rows: DataFrame, keep: list[str]) -> DataFrame:
    """keep, words, codes (their hashes) and n of each row's text."""
    split = rows.select(*keep, words(F.col("text")).alias("words"))
    return split.select(*keep, "words", F.transform("words", lambda w: F.xxhash64(w)).alias("codes"), F.size("words").alias("n"))


def _gram(at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get("codes", at + k) for k in range(size)])


def _least(size: int, at: Column) -> Column:
    """The smallest hash of a k-gram in the window of size words from a place."""
    grams = [_gram(at + k, min(size, GRAM)) for k in range(max(1, size - GRAM + 1))]
    return F.least(*grams) if len(grams) > 1 else grams[0]


def _chosen() -> Column:
    """Whether the window of SPAN words at pos has chosen another k-gram than the window before it; those after it that choose the same follow at once."""
    before, *mine = (_gram(F.col("pos") + k, GRAM) for k in range(-1, SPAN - GRAM + 1))
    return (F.col("pos") == 0) | (before < F.least(*mine[:-1])) | (mine[-1] <= F.least(before, *mine[:-1]))


def index(items: DataFrame) -> DataFrame:
    """item_id, size, print (hash of the chosen k-gram) and window (words) of the benchmark's windows, each once for an item."""
    size = F.least(F.lit(SPAN), F.col("n"))
    at = _taken(items.where("item_id is not null"), ["item_id"]).where("n > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("n") - size)).alias("pos"))
    least = F.coalesce(*[F.when(size == k, _least(k, F.col("pos"))) for k in range(1, SPAN + 1)])
    return at.select("item_id", size.alias("size"), least.alias("print"), F.slice("words", F.col("pos") + 1, size).alias("window")).distinct()


def hits(docs: DataFrame, windows: DataFrame, sizes: list[int], broadcast: bool) -> DataFrame:
    """doc, pos, size, whole (hash of the window) of each occurrence of a window, and one row with n and no pos for each row of docs (doc, text)."""
    small = F.broadcast if broadcast else lambda rows: rows
    # the row of a document and its places come from one pass: place -1 stands for the document
    at = _taken(docs, ["doc"]).select("doc", "n", "words", "codes", F.explode(F.sequence(F.lit(-1), F.col("n") - 1)).alias("pos"))
    fits = lambda k: (F.col("pos") >= 0) & (F.col("pos") <= F.col("n") - k)
    prints = [F.struct(F.lit(k).alias("size"), F.when(fits(k) & _chosen() if k == SPAN else fits(k), _least(k, F.col("pos"))).alias("print")) for k in sizes]
    seen = at.select("*", prints[0].alias("p")) if len(prints) == 1 else at.select("*", F.explode(F.array(*prints)).alias("p")).where((F.col("pos") >= 0) | (F.col("p.size") == sizes[0]))
    seen = seen.select("doc", "n", "words", "codes", "pos", F.col("p.size").alias("size"), F.col("p.print").alias("print")).where("pos < 0 or print is not null")
    last = F.when((F.col("size") == SPAN) & (F.col("pos") >= 0), F.least(F.col("pos") + (SPAN - GRAM), F.col("n") - SPAN)).otherwise(F.col("pos"))
    near = [F.col("pos").alias("first"), last.alias("last")]
    if not broadcast:
        seen = seen.select("doc", "n", "pos", "size", "print", *near, F.slice("words", F.greatest(F.lit(1), F.col("pos") + 1), F.when(F.col("pos") < 0, 0).otherwise(last - F.col("pos") + F.col("size"))).alias("words"))
    known = windows.select("size", "print").distinct().select(F.col("size").alias("s"), F.col("print").alias("f"))
    met = seen.join(small(known), (F.col("pos") >= 0) & (F.col("size") == F.col("s")) & (F.col("print") == F.col("f")), "left").where("pos < 0 or f is not null")
    if broadcast:
        met = met.select("doc", "n", "pos", "size", *near, "words")
    # extend: the windows around a meeting, word by word
    spread = met.select("doc", "n", "size", "first", "words", F.explode(F.sequence("first", "last")).alias("pos"))
    base = F.lit(1) if broadcast else F.lit(1) - F.greatest(F.lit(0), F.col("first"))
    spread = spread.select("doc", "n", "pos", "size", F.when(F.col("pos") >= 0, F.slice("words", F.col("pos") + base, F.col("size"))).alias("mine")).withColumn("whole", F.xxhash64("mine"))
    theirs = windows.select(F.col("size").alias("s"), "window").distinct().withColumn("w", F.xxhash64("window"))
    out = spread.join(small(theirs), (F.col("pos") >= 0) & (F.col("size") == F.col("s")) & (F.col("whole") == F.col("w")) & (F.col("mine") == F.col("window")), "left").where("pos < 0 or w is not null")
    return out.select("doc", F.when(F.col("pos") < 0, F.col("n")).alias("n"), F.when(F.col("pos") >= 0, F.col("pos")).alias("pos"), "size", F.col("w").alias("whole"))


def find(docs: DataFrame, items: DataFrame, least_items: int = 2, alone: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (ids as text, sorted as text), contaminated (n_items >= least_items or, with alone, a whole window of any item), one row per row of docs."""
    windows = written(index(items))
    known = windows.groupBy("size").agg(F.count("*").alias("n")).collect()  # eight rows at most
    sizes = [SPAN, *sorted(r["size"] for r in known if r["size"] != SPAN)]
    broadcast = sum(r["n"] for r in known) * BYTES <= BROADCAST
    found = written(hits(docs.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("doc"), "text"), windows, sizes, broadcast))

    # one pass over the hits of a document, in order: each adds the words beyond the furthest word so far
    spans = F.array_sort(F.collect_set(F.when(F.col("pos").isNotNull(), F.struct("pos", (F.col("pos") + F.col("size")).alias("end")))))
    start = F.struct(F.lit(0).alias("far"), F.lit(0).cast("long").alias("hit"))
    covered = F.aggregate(
        "spans",
        start,
        lambda s, x: F.struct(F.greatest(s["far"], x["end"]).alias("far"), (s["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["far"], x["pos"]))).alias("hit")),
        lambda s: s["hit"],
    )
    per_doc = found.groupBy("doc").agg(F.max("n").cast("long").alias("n_words"), F.count("n").alias("rows"), spans.alias("spans")).select("doc", "n_words", "rows", covered.alias("n_hit"))
    theirs = windows.select("item_id", "size", F.xxhash64("window").alias("whole"))
    named = found.where("pos is not null").select("doc", "size", "whole").distinct().join(theirs, ["size", "whole"])
    named = named.groupBy("doc").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"), F.max(F.col("size") == SPAN).alias("held"))
    out = per_doc.select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.hash").alias("hash"), "n_words", "n_hit", "rows")
    named = named.select(F.col("doc.doc_id").alias("d"), F.col("doc.hash").alias("h"), "items", "held")
    out = out.join(named, out["doc_id"].eqNullSafe(named["d"]) & (out["hash"] == named["h"]), "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    # rows that were equal in id and text are as many again
    out = out.select("*", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"))
    n = F.size("items").cast("long")
    return out.select("doc_id", "hash", "n_words", "n_hit", n.alias("n_items"), "items", ((n >= least_items) | (F.coalesce("held", F.lit(False)) & F.lit(alone))).alias("contaminated"))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = find(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def keep_clean(docs: DataFrame, items: DataFrame, least_items: int = 2, alone: bool = False) -> DataFrame:
    """The rows of docs, all columns, that are not contaminated."""
    bad = find(docs, items, least_items, alone).where("contaminated").select(F.col("doc_id").alias("d"), F.col("hash").alias("h")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["d"]) & (F.xxhash64(docs["text"]) == bad["h"]), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 8) AS size, array_to_string(w[p:p + least(len(w), 8) - 1], ' ') AS win
       FROM b, unnest(range(1, greatest(len(w) - 8, 0) + 2)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
h AS (SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS win
      FROM d, sizes, unnest(range(1, greatest(len(w) - size + 2, 1))) AS t(p)),
m AS (SELECT DISTINCT h.doc_id, h.p, h.size, h.win FROM h WHERE h.win IN (SELECT win FROM bw WHERE bw.size = h.size)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM m, unnest(range(p, p + size)) AS t(q) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM m JOIN bw USING (win, size) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(len(f.items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(f.items, ','), '')) AS items_sha256, coalesce(len(f.items), 0) >= 2 AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""
