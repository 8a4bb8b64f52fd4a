"""Queries about references and facts: what resolves, what repeats, what is inherited, what was told first."""

from __future__ import annotations

from pyspark.sql import functions as F

from docledger import ids
from docledger.functions import values
from docledger.operators import ledger
from docledger.plans.documents import table


def unresolved_refs(spark, sf_dir):
    return ledger.unresolved(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), ["doc_id"])


def duplicate_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(ids.doc_id(F.col("text")).alias("document_id"))
    return ledger.duplicated(docs, ["document_id"])


def artifact_index_pairing(spark, sf_dir):
    return ledger.pairing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1").withColumn("doc_id", F.col("doc_id") + F.when(F.col("toxic") == 1, 1_000_000).otherwise(0)), "doc_id", ("artifact", "index"))


ARTIFACT_INDEX_PAIRING = """
WITH a AS (SELECT doc_id, count(*) AS n FROM documents GROUP BY 1), b AS (SELECT doc_id + CASE WHEN toxic = 1 THEN 1000000 ELSE 0 END AS doc_id, count(*) AS m FROM labels WHERE quality = 1 GROUP BY 1)
SELECT doc_id, CASE WHEN n IS NULL THEN 'missing artifact' WHEN m IS NULL THEN 'missing index' WHEN n > 1 THEN 'duplicate artifact' WHEN m > 1 THEN 'duplicate index' ELSE 'ok' END AS verdict FROM a FULL JOIN b USING (doc_id)"""


def diagnostics_first(spark, sf_dir):
    """The first event of each user and type, as the first diagnostic of each code and part."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return ledger.first_of(events, ["user_id", "event_type"], ["event_id"])


def props_without_provenance(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    payload = F.create_map(F.lit("k"), k, F.lit("source_node_id"), k, F.lit("rawXml"), k, F.lit("Path"), k, F.lit("target_part"), F.concat(F.lit("t"), k))
    return events.select("event_id", F.to_json(values.without_provenance(payload)).alias("payload"))


PROPS = "SELECT event_id, '{\"k\":\"' || json_extract_string(props, '$.k') || '\",\"target_part\":\"t' || json_extract_string(props, '$.k') || '\"}' AS payload FROM events"


def classification_cache(spark, sf_dir):
    """Assets beside what a cache knows of them under the same classifier and prompt."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.concat(F.lit("c"), (F.col("doc_id") % 2).cast("string")).alias("classifier"), F.lit("p1").alias("prompt"))
    known = docs.where("doc_id % 5 = 0").groupBy("sha", "classifier", "prompt").agg(F.min("doc_id").alias("label"))
    key = F.concat(F.lit("image-classification-"), F.sha2(F.concat("sha", F.decode(F.unhex(F.lit("00")), "utf-8"), "classifier", F.decode(F.unhex(F.lit("00")), "utf-8"), "prompt"), 256))
    return docs.join(known, ["sha", "classifier", "prompt"], "left").select("doc_id", key.alias("cache_key"), "label")


CLASSIFICATION_CACHE = """
WITH d AS (SELECT doc_id, sha256(text) AS sha, 'c' || doc_id % 2 AS classifier, 'p1' AS prompt FROM documents),
k AS (SELECT sha, classifier, prompt, min(doc_id) AS label FROM d WHERE doc_id % 5 = 0 GROUP BY ALL)
SELECT doc_id, 'image-classification-' || sha256(encode(sha) || unhex('00') || encode(classifier) || unhex('00') || encode(prompt)) AS cache_key, label FROM d LEFT JOIN k USING (sha, classifier, prompt)"""


def style_inheritance(spark, sf_dir):
    """Customers as styles, chains of 200 of them based on one another: the nearest balance and segment that is known on the way up."""
    c = table(spark, sf_dir, "customer")
    styles = c.select(
        F.col("c_custkey").alias("style_id"), F.when(F.col("c_custkey") % 200 != 1, F.col("c_custkey") - 1).alias("based_on"),
        F.when(F.col("c_custkey") % 400 == 1, F.col("c_mktsegment")).alias("name"), F.when(F.col("c_custkey") % 97 == 0, F.col("c_nationkey")).alias("outline_level"),
    )
    return ledger.chain(styles, "style_id", "based_on", ["name", "outline_level"])


STYLE_INHERITANCE = """
WITH RECURSIVE s AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 200 <> 1 THEN c_custkey - 1 END AS up, CASE WHEN c_custkey % 400 = 1 THEN c_mktsegment END AS name, CASE WHEN c_custkey % 97 = 0 THEN c_nationkey END AS o FROM customer),
w AS (SELECT id, id AS at, 0 AS d FROM s UNION ALL SELECT w.id, s.up, d + 1 FROM w JOIN s ON s.id = w.at WHERE s.up IS NOT NULL)
SELECT w.id AS style_id, arg_min(s.name, d) FILTER (WHERE s.name IS NOT NULL) AS name, arg_min(s.o, d) FILTER (WHERE s.o IS NOT NULL) AS outline_level FROM w JOIN s ON s.id = w.at GROUP BY 1"""


def numbering_levels(spark, sf_dir):
    """Lines beside their part's level, with the supplier's start in place of the part's where it has one."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    levels = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("start"), F.col("p_brand").alias("num_fmt"))
    overrides = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("start_override"))
    return lines.join(levels, "l_partkey").join(overrides, "l_suppkey", "left").select("l_orderkey", "l_linenumber", "num_fmt", F.coalesce("start_override", "start").alias("start"))


NUMBERING_LEVELS = "SELECT l_orderkey, l_linenumber, p_brand AS num_fmt, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey END, p_size) AS start FROM lineitem JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey"


def outline_provenance(spark, sf_dir):
    """Labels as references of slides to documents: which do not resolve, and which slides have no evidence at all."""
    refs = table(spark, sf_dir, "labels").select((F.col("doc_id") % 50).alias("slide_id"), (F.col("doc_id") * (1 + F.col("toxic"))).alias("doc_id"))
    known = table(spark, sf_dir, "documents").select("doc_id", F.lit(True).alias("known"))
    per = refs.join(known, "doc_id", "left").groupBy("slide_id").agg(F.count("*").alias("refs"), F.count_if(F.col("known").isNull()).alias("unresolved"))
    return per.select("slide_id", "refs", "unresolved", F.when(F.col("unresolved") == F.col("refs"), "without evidence").when(F.col("unresolved") > 0, "unresolved").otherwise("ok").alias("verdict"))


OUTLINE_PROVENANCE = """
WITH r AS (SELECT doc_id % 50 AS slide_id, doc_id * (1 + toxic) AS ref FROM labels), j AS (SELECT slide_id, count(*) AS refs, count(*) FILTER (WHERE d.doc_id IS NULL) AS unresolved FROM r LEFT JOIN documents d ON d.doc_id = r.ref GROUP BY 1)
SELECT slide_id, refs, unresolved, CASE WHEN unresolved = refs THEN 'without evidence' WHEN unresolved > 0 THEN 'unresolved' ELSE 'ok' END AS verdict FROM j"""

QUERIES = {
    "unresolved_refs": (unresolved_refs, "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    "duplicate_ids": (duplicate_ids, "SELECT 'doc-' || substr(sha256(text), 1, 16) AS document_id, count(*)::BIGINT AS n FROM documents GROUP BY 1 HAVING count(*) > 1"),
    "artifact_index_pairing": (artifact_index_pairing, ARTIFACT_INDEX_PAIRING),
    "diagnostics_first": (diagnostics_first, "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2"),
    "props_without_provenance": (props_without_provenance, PROPS),
    "classification_cache": (classification_cache, CLASSIFICATION_CACHE),
    "style_inheritance": (style_inheritance, STYLE_INHERITANCE),
    "numbering_levels": (numbering_levels, NUMBERING_LEVELS),
    "outline_provenance": (outline_provenance, OUTLINE_PROVENANCE),
}
