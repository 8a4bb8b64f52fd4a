"""Queries over the ledger of documents: identities, blocks, assets, inventories, coverage, health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger import ids
from docledger.operators import hierarchy, ledger
from docledger.sources import adapters


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINES = "lines AS (SELECT doc_id, 'doc-' || doc_id AS doc, t.i AS pos, l[t.i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), unnest(range(1, len(l) + 1)) AS t(i))"
P = "'/w:document/w:body[1]/w:p[' || pos || ']'"
IDS = f"named AS (SELECT *, {ids.sql_node_id('doc', P, "'paragraph'")} AS p_id, {ids.sql_node_id('doc', P + " || '/w:r[1]'", "'text_run'")} AS r_id FROM lines)"


def _paragraphs(spark, sf_dir) -> DataFrame:
    """doc_id, doc, pos, line, p_id, r_id: one row for each line, made without a shuffle."""
    lines = adapters.document_lines(table(spark, sf_dir, "documents"))
    doc, path = F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), F.concat(F.lit(f"{adapters.BODY}/w:p["), F.col("pos").cast("string"), F.lit("]"))
    rows = lines.select("doc_id", doc.alias("doc"), "pos", "line", path.alias("path"))
    return rows.select("doc_id", "doc", "pos", "line", ids.node_id(F.col("doc"), adapters.PART, F.col("path"), "paragraph").alias("p_id"), ids.node_id(F.col("doc"), adapters.PART, F.concat("path", F.lit("/w:r[1]")), "text_run").alias("r_id"))


def doc_text_blocks(spark, sf_dir):
    rows = _paragraphs(spark, sf_dir)
    return rows.select("doc_id", "pos", F.col("p_id").alias("node_id"), ids.view_id("semantic-blocks", "1.0.0", ids.CONFIG_JSON, F.array("p_id", "r_id")).alias("block_id"), F.col("line").alias("content"))


_JSON = "'[\"' || p_id || '\",\"' || r_id || '\"]'"
_BLOCK = ids.sql_view_id("semantic-blocks", ids.CONFIG_JSON, _JSON)
DOC_TEXT_BLOCKS = f"WITH {LINES}, {IDS} SELECT doc_id, pos::INTEGER AS pos, p_id AS node_id, {_BLOCK} AS block_id, line AS content FROM named"


def doc_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ids.doc_id(F.col("text")).alias("document_id"), ids.asset_id(F.col("text")).alias("asset_id"))


DOC_IDS = "SELECT doc_id, 'doc-' || substr(sha256(text), 1, 16) AS document_id, 'asset-' || sha256(text) AS asset_id FROM documents"


def content_assets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("name", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    return ledger.assets(docs, "text", "name", "source", "doc_id")


CONTENT_ASSETS = """
SELECT 'asset-' || sha256(text) AS asset_id, count(*)::BIGINT AS occurrences, arg_min('doc-' || doc_id, doc_id) AS original_name,
       array_to_string(list_sort(list(DISTINCT source)), ',') AS source_parts FROM documents GROUP BY 1"""


def ledger_sequence(spark, sf_dir):
    return adapters.documents(table(spark, sf_dir, "documents")).select("doc_id", "seq", "parent_seq", "sibling_index", "kind", "node_id")


LEDGER_SEQUENCE = f"""
WITH {LINES}, {IDS}
SELECT doc_id, 0::BIGINT AS seq, NULL::BIGINT AS parent_seq, 0::BIGINT AS sibling_index, 'document_body' AS kind, {ids.sql_node_id("'doc-' || doc_id", "'/w:document/w:body[1]'", "'document_body'")} AS node_id FROM documents
UNION ALL SELECT doc_id, 2 * pos - 1, 0, pos - 1, 'paragraph', p_id FROM named
UNION ALL SELECT doc_id, 2 * pos, 2 * pos - 1, 0, 'text_run', r_id FROM named"""


def ledger_integrity(spark, sf_dir):
    return ledger.integrity(adapters.documents(table(spark, sf_dir, "documents")), "doc")


LEDGER_INTEGRITY = "SELECT 'doc-' || doc_id AS doc, (1 + 2 * coalesce(len(string_split(text, chr(10))), 0))::BIGINT AS n_nodes, 0::BIGINT AS duplicate_ids, 0::BIGINT AS gaps, 0::BIGINT AS missing_parents FROM documents"


def feature_inventory(spark, sf_dir):
    lines = adapters.document_lines(table(spark, sf_dir, "documents"))
    per = lines.groupBy("doc_id").agg(F.count("*").alias("paragraphs"), F.count_if(F.length("line") > 0).alias("visible_text_nodes"), F.sum(F.length("line")).alias("visible_text_chars"))
    return per.unpivot(["doc_id"], ["paragraphs", "visible_text_nodes", "visible_text_chars"], "feature", "total")


FEATURE_INVENTORY = f"""
WITH {LINES}, c AS (SELECT doc_id, count(*)::BIGINT AS paragraphs, count(*) FILTER (WHERE length(line) > 0)::BIGINT AS visible_text_nodes, sum(length(line))::BIGINT AS visible_text_chars FROM lines GROUP BY 1)
SELECT doc_id, feature, total FROM c UNPIVOT (total FOR feature IN (paragraphs, visible_text_nodes, visible_text_chars))"""


def _coverage(spark, sf_dir):
    lines = adapters.document_lines(table(spark, sf_dir, "documents"))
    counts = lines.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.count_if(F.trim("line") != "").alias("good"), F.sum(F.length("line")).alias("chars"), F.sum(F.length(F.trim("line"))).alias("shown")
    )
    told = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.count("*").alias("diagnosed"))
    rows = counts.join(told, "doc_id", "left").withColumn("diagnosed", F.coalesce("diagnosed", F.lit(0).cast("long")))
    parts = F.array(
        F.struct(F.lit("visible_text_nodes").alias("feature"), F.col("n").alias("source"), F.col("good").alias("extracted"), F.col("diagnosed")),
        F.struct(F.lit("visible_text_chars").alias("feature"), F.col("chars").alias("source"), F.col("shown").alias("extracted"), F.lit(0).cast("long").alias("diagnosed")),
    )
    return ledger.coverage(rows.select("doc_id", F.explode(parts).alias("x")).select("doc_id", "x.*"), ["doc_id"])


def coverage_report(spark, sf_dir):
    return _coverage(spark, sf_dir)


_COUNTS = f"""{LINES}, c AS (SELECT doc_id, count(*)::BIGINT AS n, count(*) FILTER (WHERE trim(line, ' ') != '')::BIGINT AS good, sum(length(line))::BIGINT AS chars, sum(length(trim(line, ' ')))::BIGINT AS shown FROM lines GROUP BY 1),
l AS (SELECT doc_id, count(*)::BIGINT AS d FROM labels GROUP BY 1),
f AS (SELECT doc_id, 'visible_text_nodes' AS feature, n AS source, good AS got, coalesce(d, 0) AS d FROM c LEFT JOIN l USING (doc_id) UNION ALL SELECT doc_id, 'visible_text_chars', chars, shown, 0 FROM c),
r AS (SELECT doc_id, feature, source, CASE WHEN source > 0 THEN least(got, source) ELSE got END AS extracted, least(greatest(0, source - got), d) AS diagnosed, greatest(0, source - got) AS failed FROM f)"""
COVERAGE_REPORT = f"WITH {_COUNTS} SELECT doc_id, feature, source, extracted::BIGINT AS extracted, diagnosed::BIGINT AS diagnosed, (failed - diagnosed)::BIGINT AS silent, CASE WHEN source = 0 THEN 1.0::DOUBLE ELSE round(extracted / source, 6) END AS ratio FROM r"


def artifact_health(spark, sf_dir):
    silent = _coverage(spark, sf_dir).groupBy("doc_id").agg(F.sum("silent").alias("silent_losses"))
    health = F.when(F.col("silent_losses") > 0, "degraded").otherwise("ready")
    return silent.select("doc_id", "silent_losses", health.alias("health"))


ARTIFACT_HEALTH = f"WITH {_COUNTS} SELECT doc_id, sum(failed - diagnosed)::BIGINT AS silent_losses, CASE WHEN sum(failed - diagnosed) > 0 THEN 'degraded' ELSE 'ready' END AS health FROM r GROUP BY 1"


def caption_links(spark, sf_dir):
    """A short line is an image, a line that begins like a caption is one."""
    lines = _paragraphs(spark, sf_dir)
    lines = lines.select("doc_id", F.col("pos").cast("long").alias("seq"), hierarchy.caption_strength(F.lit(""), F.concat(F.lit("Figure 1: "), "line")).alias("any"), "line")
    blocks = lines.select("doc_id", "seq", F.when(F.length("line") >= 200, F.col("any")).alias("strength"), F.when(F.length("line") < 40, F.col("seq")).alias("target_seq"))
    return hierarchy.captions(blocks, ["doc_id"]).select("doc_id", "seq", "linked_seq", F.col("strength").alias("confidence"))


CAPTION_LINKS = f"""
WITH {LINES}, b AS (SELECT doc_id, pos, length(line) AS n FROM lines),
c AS (SELECT a.doc_id, a.pos AS seq, coalesce(CASE WHEN p.n < 40 THEN p.pos END, CASE WHEN x.n < 40 THEN x.pos END) AS linked_seq
      FROM b a LEFT JOIN b p ON p.doc_id = a.doc_id AND p.pos = a.pos - 1 LEFT JOIN b x ON x.doc_id = a.doc_id AND x.pos = a.pos + 1 WHERE a.n >= 200)
SELECT doc_id, seq, linked_seq, 0.75::DOUBLE AS confidence FROM c WHERE linked_seq IS NOT NULL"""


def document_content(spark, sf_dir):
    nodes = adapters.documents(table(spark, sf_dir, "documents"))
    shown = nodes.select("doc_id", "seq", ledger.visible(F.col("kind"), F.col("text"), F.lit(None).cast("string"), F.lit(False)).alias("text")).where("text is not null")
    return ledger.joined_text(shown, ["doc_id"]).select("doc_id", F.sha2("content", 256).alias("content_sha256"), F.length("content").cast("long").alias("n_chars"))


DOCUMENT_CONTENT = "SELECT doc_id, sha256(replace(text, chr(10), '')) AS content_sha256, length(replace(text, chr(10), ''))::BIGINT AS n_chars FROM documents WHERE text IS NOT NULL"


def evidence_items(spark, sf_dir):
    rows = _paragraphs(spark, sf_dir).withColumn("sources", F.array("p_id", "r_id"))
    blocks = rows.select("doc_id", "doc", F.when(F.col("pos") == 1, "title").when(F.length("line") == 0, "unsupported").otherwise("text").alias("kind"), ids.view_id("semantic-blocks", "1.0.0", ids.CONFIG_JSON, F.col("sources")).alias("block_id"), "sources", F.col("line").alias("text"))
    return ledger.evidence(blocks).select("doc_id", "evidence_id", "kind", "block_id", "text")


_EVIDENCE = f"""{LINES}, {IDS}, b AS (SELECT doc_id, doc, CASE WHEN pos = 1 THEN 'title' WHEN length(line) = 0 THEN 'unsupported' ELSE 'text' END AS kind, {_BLOCK} AS block_id, {_JSON} AS src, line FROM named),
e AS (SELECT doc_id, 'evidence-' || substr({ids.sql_digest("doc", "'1.0.0'", "kind", "block_id", "'primary'", "src")}, 1, 24) AS evidence_id, kind, block_id, line AS text FROM b WHERE kind != 'unsupported')"""
EVIDENCE_ITEMS = f"WITH {_EVIDENCE} SELECT * FROM e"


def evidence_kinds(spark, sf_dir):
    return evidence_items(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("items"), F.count_distinct("doc_id").alias("documents"))


EVIDENCE_KINDS = f"WITH {_EVIDENCE} SELECT kind, count(*)::BIGINT AS items, count(DISTINCT doc_id)::BIGINT AS documents FROM e GROUP BY 1"


def prompt_payload(spark, sf_dir):
    payload = F.to_json(F.struct(F.struct(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("doc_id"), F.concat(F.col("doc_id").cast("string"), F.lit(".docx")).alias("filename")).alias("document"), F.struct("lang", "source").alias("facts")))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(payload, 256).alias("payload_sha256"), F.length(payload).cast("long").alias("n_chars"))


_PAYLOAD = "to_json({'document': {'doc_id': 'doc-' || doc_id, 'filename': doc_id || '.docx'}, 'facts': {'lang': lang, 'source': source}})::VARCHAR"
PROMPT_PAYLOAD = f"SELECT doc_id, sha256({_PAYLOAD}) AS payload_sha256, length({_PAYLOAD})::BIGINT AS n_chars FROM documents"


QUERIES = {
    "doc_text_blocks": (doc_text_blocks, DOC_TEXT_BLOCKS),
    "doc_ids": (doc_ids, DOC_IDS),
    "content_assets": (content_assets, CONTENT_ASSETS),
    "document_content": (document_content, DOCUMENT_CONTENT),
    "ledger_sequence": (ledger_sequence, LEDGER_SEQUENCE),
    "ledger_integrity": (ledger_integrity, LEDGER_INTEGRITY),
    "feature_inventory": (feature_inventory, FEATURE_INVENTORY),
    "coverage_report": (coverage_report, COVERAGE_REPORT),
    "artifact_health": (artifact_health, ARTIFACT_HEALTH),
    "caption_links": (caption_links, CAPTION_LINKS),
    "evidence_items": (evidence_items, EVIDENCE_ITEMS),
    "evidence_kinds": (evidence_kinds, EVIDENCE_KINDS),
    "prompt_payload": (prompt_payload, PROMPT_PAYLOAD),
}
