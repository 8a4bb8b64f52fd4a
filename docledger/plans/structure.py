"""Queries over conversations and pages: sections, lists, headings, links."""

from __future__ import annotations

from pyspark.sql import functions as F

from docledger import ids
from docledger.functions import values
from docledger.operators import hierarchy, ledger
from docledger.plans.documents import table
from docledger.sources import adapters


def _turns(spark, sf_dir):
    rows = adapters.conversations(table(spark, sf_dir, "conversations"))
    heading = hierarchy.heading_of(F.col("outline_level"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    return rows.select("*", heading.alias("h")).select("*", F.col("h.is_heading").alias("is_heading"), F.col("h.level").alias("level"), F.col("h.via").alias("via")).drop("h")


def conversation_sections(spark, sf_dir):
    out = hierarchy.sections(_turns(spark, sf_dir), ["doc"])
    return out.select(F.col("doc").alias("conv_id"), "seq", "level", "via", "parent_seq", "end_seq", F.col("text").alias("title"))


_TURNS = "t AS (SELECT conv_id, turn AS seq, role, text, CASE role WHEN 'user' THEN 1 WHEN 'system' THEN 2 END AS level, (length(text) % 4)::INTEGER AS list_level FROM conversations)"
CONVERSATION_SECTIONS = f"""
WITH {_TURNS}, h AS (SELECT * FROM t WHERE level IS NOT NULL)
SELECT conv_id, seq, level, 'outline_level' AS via, (SELECT max(b.seq) FROM h b WHERE b.conv_id = a.conv_id AND b.seq < a.seq AND b.level < a.level) AS parent_seq,
       (SELECT min(b.seq) FROM h b WHERE b.conv_id = a.conv_id AND b.seq > a.seq AND b.level <= a.level) AS end_seq, text AS title FROM h a"""


def section_members(spark, sf_dir):
    """What stands in each section: the turns from its heading up to its end."""
    inside = hierarchy.enclosing(_turns(spark, sf_dir), ["doc"]).select("doc", "seq", F.length("text").alias("n"), F.explode("roots").alias("root"))
    return inside.groupBy(F.col("doc").alias("conv_id"), F.col("root").alias("seq")).agg(F.count("*").alias("members"), F.sum("n").cast("long").alias("n_chars"), F.max(inside["seq"]).alias("last_seq"))


SECTION_MEMBERS = f"""
WITH {_TURNS}, h AS (SELECT * FROM t WHERE level IS NOT NULL),
s AS (SELECT conv_id, seq, coalesce((SELECT min(b.seq) FROM h b WHERE b.conv_id = a.conv_id AND b.seq > a.seq AND b.level <= a.level), 1000000000) AS stop FROM h a)
SELECT s.conv_id, s.seq, count(*)::BIGINT AS members, sum(length(t.text))::BIGINT AS n_chars, max(t.seq) AS last_seq FROM s JOIN t ON t.conv_id = s.conv_id AND t.seq >= s.seq AND t.seq < s.stop GROUP BY 1, 2"""


def section_evidence(spark, sf_dir):
    """The turns of each section in order, as ids."""
    turns = _turns(spark, sf_dir).withColumn("id", ids.node_id(F.col("doc").cast("string"), adapters.PART, F.col("seq").cast("string"), "paragraph"))
    inside = hierarchy.enclosing(turns, ["doc"]).select("doc", "seq", "id", F.explode("roots").alias("root"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("seq", "id"))), lambda x: x["id"])
    return inside.groupBy(F.col("doc").alias("conv_id"), F.col("root").alias("seq")).agg(F.sha2(F.array_join(in_order, ","), 256).alias("evidence_sha256"))


SECTION_EVIDENCE = f"""
WITH {_TURNS}, n AS (SELECT *, {ids.sql_node_id("conv_id::VARCHAR", "seq::VARCHAR", "'paragraph'")} AS id FROM t), h AS (SELECT * FROM n WHERE level IS NOT NULL),
s AS (SELECT conv_id, seq, coalesce((SELECT min(b.seq) FROM h b WHERE b.conv_id = a.conv_id AND b.seq > a.seq AND b.level <= a.level), 1000000000) AS stop FROM h a)
SELECT s.conv_id, s.seq, sha256(string_agg(n.id, ',' ORDER BY n.seq)) AS evidence_sha256 FROM s JOIN n ON n.conv_id = s.conv_id AND n.seq >= s.seq AND n.seq < s.stop GROUP BY 1, 2"""


def _lists(spark, sf_dir):
    rows = _turns(spark, sf_dir)
    return hierarchy.lists(rows, ["doc"], "seq", F.col("num_id").isNotNull() & ~F.col("is_heading"), ["num_id"])


def conversation_lists(spark, sf_dir):
    return _lists(spark, sf_dir).groupBy(F.col("doc").alias("conv_id"), "list_no").agg(F.count("*").alias("items"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


_RUNS = f"{_TURNS}, g AS (SELECT *, sum(CASE WHEN role = 'assistant' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY seq) AS grp FROM t), l AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY grp) AS list_no FROM g WHERE role = 'assistant')"
CONVERSATION_LISTS = f"WITH {_RUNS} SELECT conv_id, list_no, count(*)::BIGINT AS items, min(seq) AS first_seq, max(seq) AS last_seq FROM l GROUP BY 1, 2"


def list_nesting(spark, sf_dir):
    """Every turn as an item of its conversation's list, nested by level."""
    rows = _turns(spark, sf_dir)
    return hierarchy.nest_items(rows, ["doc"]).select(F.col("doc").alias("conv_id"), "seq", "list_level", "parent_seq")


LIST_NESTING = f"WITH {_TURNS} SELECT conv_id, seq, list_level, (SELECT max(b.seq) FROM t b WHERE b.conv_id = a.conv_id AND b.seq < a.seq AND b.list_level < a.list_level) AS parent_seq FROM t a"


def section_hierarchy(spark, sf_dir):
    """Nine levels of headings: every line of documents, its level by its length."""
    lines = adapters.document_lines(table(spark, sf_dir, "documents"))
    heads = lines.select("doc_id", F.col("pos").cast("long").alias("seq"), (F.length("line") % 9 + 1).cast("int").alias("level"))
    return hierarchy.sections(heads, ["doc_id"]).select("doc_id", "seq", "level", "parent_seq", "end_seq")


SECTION_HIERARCHY = """
WITH lines AS (SELECT doc_id, t.i AS seq, l[t.i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) AS t(i)),
h AS (SELECT doc_id, seq, (length(line) % 9 + 1)::INTEGER AS level FROM lines)
SELECT doc_id, seq, level, (SELECT max(b.seq) FROM h b WHERE b.doc_id = a.doc_id AND b.seq < a.seq AND b.level < a.level) AS parent_seq,
       (SELECT min(b.seq) FROM h b WHERE b.doc_id = a.doc_id AND b.seq > a.seq AND b.level <= a.level) AS end_seq FROM h a"""


def _found(spark, sf_dir, pattern: str, into: str):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("pos", into))


def _sql_found(pattern: str, into: str) -> str:
    return f"SELECT page_id, (t.i - 1)::INTEGER AS pos, x[t.i] AS {into} FROM (SELECT page_id, regexp_extract_all(html, '{pattern}', 1) AS x FROM pages), unnest(range(1, len(x) + 1)) AS t(i)"


_LINK, _HEADING, _ITEM = '<a href="([^"]*)">', "<h1>([^<]*)</h1>", "<li>(?:<a[^>]*>)?([^<]*)"


def link_targets(spark, sf_dir):
    """Links resolved against parts by the rules of package relationships; unsafe ones have no target."""
    links = _found(spark, sf_dir, _LINK, "url")
    climbing = F.concat(F.when(F.col("pos") % 3 == 0, "..").when(F.col("pos") % 3 == 1, "../..").otherwise("./a/.."), "url")
    source = F.lit("word/sub/document.xml")
    return links.select("page_id", "pos", values.target(source, climbing).alias("inside"), values.target(source, F.col("url")).alias("absolute"), values.relationship_part(F.lit("word/document.xml")).alias("rels"))


LINK_TARGETS = f"""
WITH l AS ({_sql_found(_LINK, "url")}),
k AS (SELECT page_id, pos, list_filter(string_split(regexp_replace(url, '[#?].*$', ''), '/'), lambda y: y NOT IN ('', '.')) AS rest FROM l)
SELECT page_id, pos, CASE pos % 3 WHEN 0 THEN CASE WHEN len(rest) = 0 THEN 'word' ELSE 'word/' || array_to_string(rest, '/') END
       WHEN 1 THEN CASE WHEN len(rest) = 0 THEN NULL ELSE array_to_string(rest, '/') END
       ELSE CASE WHEN len(rest) = 0 THEN 'word/sub' ELSE 'word/sub/' || array_to_string(rest, '/') END END AS inside,
       NULL::VARCHAR AS absolute, 'word/_rels/document.xml.rels' AS rels FROM k"""


def page_assets(spark, sf_dir):
    """Files that pages would be stored as."""
    pages = table(spark, sf_dir, "pages")
    mime = F.when(F.col("page_id") % 3 == 0, "image/png").when(F.col("page_id") % 3 == 1, "image/unknown")
    return pages.select("page_id", F.concat(ids.asset_id(F.col("html")), values.extension(mime, F.concat(F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".HTML").otherwise("")))).alias("file_name"))


PAGE_ASSETS = "SELECT page_id, 'asset-' || sha256(html) || CASE WHEN page_id % 3 = 0 THEN '.png' WHEN page_id % 2 = 0 THEN '.html' ELSE '.bin' END AS file_name FROM pages"


QUERIES = {
    "conversation_sections": (conversation_sections, CONVERSATION_SECTIONS),
    "section_members": (section_members, SECTION_MEMBERS),
    "section_evidence": (section_evidence, SECTION_EVIDENCE),
    "conversation_lists": (conversation_lists, CONVERSATION_LISTS),
    "list_nesting": (list_nesting, LIST_NESTING),
    "section_hierarchy": (section_hierarchy, SECTION_HIERARCHY),
    "link_targets": (link_targets, LINK_TARGETS),
    "page_assets": (page_assets, PAGE_ASSETS),
}
