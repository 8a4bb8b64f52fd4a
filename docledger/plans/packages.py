"""Queries over packages: each document of the table is written as one, line by line, and read back by the package reader.

What a line becomes follows from its length n in characters: n % 8 is 0 a heading (style Heading1 to Heading3 by n // 8 % 3), 1 an item of a
numbered list (level n // 8 % 2), 2 a caption, 3 a table of three rows and two columns, 4 an image, 5 an equation, 6 a hyperlink, 7 plain text. Empty
lines are left out, as are characters that XML cannot hold. One relationship leads, by doc_id % 3, to a part, to none, or out of the package.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.lineage import written
from docledger.operators import views
from docledger.plans.documents import table
from docledger.sources import packages
from docledger.sources.xmltree import RELS, TYPES, WP, A, M, R, W

_SPACES = f'xmlns:w="{W}" xmlns:r="{R}" xmlns:a="{A}" xmlns:m="{M}" xmlns:wp="{WP}"'
_NO_XML = re.compile("[\x00-\x08\x0b-\x1f￾￿]")
_PIXEL = b"GIF89a\x01\x00\x01\x00\x00\x00\x00;"
_STYLES = "".join(f'<w:style w:type="paragraph" w:styleId="Heading{k}"><w:name w:val="heading {k}"/></w:style>' for k in (1, 2, 3)) + '<w:style w:type="paragraph" w:styleId="Caption"><w:name w:val="caption"/></w:style>'
_LEVELS = "".join(f'<w:lvl w:ilvl="{k}"><w:numFmt w:val="{f}"/><w:lvlText w:val="%{k + 1}."/></w:lvl>' for k, f in ((0, "decimal"), (1, "bullet")))
_NUMBERS = f'<w:abstractNum w:abstractNumId="1">{_LEVELS}</w:abstractNum><w:num w:numId="5"><w:abstractNumId w:val="1"/></w:num>'


def _run(text: str) -> str:
    return f'<w:r><w:t xml:space="preserve">{escape(text)}</w:t></w:r>'


def _paragraph(inner: str, facts: str = "") -> str:
    return f"<w:p>{f'<w:pPr>{facts}</w:pPr>' if facts else ''}{inner}</w:p>"


def _line(line: str, place: int) -> str:
    n = len(line)
    step = n // 8
    rows = (("Kind", "Count"), (f"t {line}", str(n)), ("place", str(place)))
    return (
        lambda: _paragraph(_run(line), f'<w:pStyle w:val="Heading{step % 3 + 1}"/>'),
        lambda: _paragraph(_run(line), f'<w:numPr><w:ilvl w:val="{step % 2}"/><w:numId w:val="5"/></w:numPr>'),
        lambda: _paragraph(_run(line), '<w:pStyle w:val="Caption"/>'),
        lambda: "<w:tbl><w:tblGrid><w:gridCol/><w:gridCol/></w:tblGrid>" + "".join("<w:tr>" + "".join(f"<w:tc>{_paragraph(_run(c))}</w:tc>" for c in row) + "</w:tr>" for row in rows) + "</w:tbl>",
        lambda: _paragraph('<w:r><w:drawing><wp:inline><a:graphic><a:blip r:embed="rId1"/></a:graphic></wp:inline></w:drawing></w:r>'),
        lambda: _paragraph(f"<m:oMath><m:r><m:t>{n}</m:t></m:r></m:oMath>"),
        lambda: _paragraph(f'<w:hyperlink r:id="rId2">{_run(line)}</w:hyperlink>'),
        lambda: _paragraph(_run(line)),
    )[n % 8]()


def package(doc_id: int, text: str | None) -> bytes:
    """The bytes of a document's package."""
    lines = [x for x in _NO_XML.sub("", text or "").split("\n") if x]
    stray = ("media/a.gif", "media/none.gif", "../../out.gif")[doc_id % 3]
    links = ((f"{R}/image", "media/a.gif", ""), (f"{R}/hyperlink", "http://example.org/", ' TargetMode="External"'), (f"{R}/image", stray, ""))
    members = {
        "[Content_Types].xml": f'<Types xmlns="{TYPES}"><Default Extension="xml" ContentType="application/xml"/><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="gif" ContentType="image/gif"/></Types>',
        "word/document.xml": f"<w:document {_SPACES}><w:body>{''.join(_line(x, k + 1) for k, x in enumerate(lines))}</w:body></w:document>",
        "word/styles.xml": f"<w:styles {_SPACES}>{_STYLES}</w:styles>",
        "word/numbering.xml": f"<w:numbering {_SPACES}>{_NUMBERS}</w:numbering>",
        "word/_rels/document.xml.rels": f'<Relationships xmlns="{RELS}">' + "".join(f'<Relationship Id="rId{k + 1}" Type="{t}" Target="{to}"{mode}/>' for k, (t, to, mode) in enumerate(links)) + "</Relationships>",
        "word/media/a.gif": _PIXEL,
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def _dealt(documents: DataFrame) -> DataFrame:
    """The same rows, over as many tasks as keep all cores at work: reading a package costs far more than its bytes, by which Spark deals out files."""
    size = int(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return documents.repartition(max(4 * documents.sparkSession.sparkContext.defaultParallelism, min(size // TASK_BYTES, 20000)))


#: Bytes of a table of documents that one task turns into packages and reads.
TASK_BYTES = 4 << 20


def files(documents: DataFrame) -> DataFrame:
    """path and content of each document's package."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                ids, texts = (batch.column(c).slice(k, 64).to_pylist() for c in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array([f"{d}.docx" for d in ids]), pa.array([package(d, t) for d, t in zip(ids, texts, strict=True)], pa.binary())], names=["path", "content"])

    return _dealt(documents.select("doc_id", "text")).mapInArrow(run, "path string, content binary")


def _parsed(spark, sf_dir, **lists) -> DataFrame:
    """Documents as parsed, with the lists that are named, and of each the fields (all if there are none)."""
    return packages.parse(files(table(spark, sf_dir, "documents")), only=lists)


def _ledgers(spark, sf_dir, **lists) -> DataFrame:
    """doc, doc_id and nodes of each document, for views that read them once."""
    return _parsed(spark, sf_dir, nodes=views.FIELDS, **lists).select("doc", "doc_id", "nodes", *lists)


def _written(spark, sf_dir, **lists) -> DataFrame:
    """The same, parsed once and written, for views that read them more often."""
    return written(_ledgers(spark, sf_dir, **lists))


#: Fields of nodes that features are counted by.
COUNTED = ["kind", "status", "text", "deleted", "instruction"]


def _of(rows: DataFrame) -> DataFrame:
    """rows with the number of the document in place of its name."""
    return rows.select(F.substring_index("doc", ".", 1).cast("long").alias("doc_number"), *[c for c in rows.columns if c not in ("doc", "doc_id")])


def package_nodes(spark, sf_dir):
    """Every node that stands at the top of a body: where it stands, as what, and how far it reaches."""
    n = packages.table(_parsed(spark, sf_dir, nodes=["sequence", "sibling_index", "kind", "xml_path", "style_id", "num_id", "list_level", "subtree_end", "ancestors"]), "nodes").where(F.size("ancestors") == 1)
    return _of(n.select("doc", "sequence", "sibling_index", "kind", "xml_path", "style_id", "num_id", "list_level", "subtree_end"))


def package_blocks(spark, sf_dir):
    """What a reader sees, in order. A list begins where its first item does."""
    b = views.blocks(_written(spark, sf_dir)).select("doc", "seq", "kind", "text", F.size("sources").alias("n_sources"))
    return _of(b.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("seq", "kind")).alias("place"), "kind", "text", "n_sources"))


def package_lists(spark, sf_dir):
    items = views.list_items(_ledgers(spark, sf_dir))
    return _of(items.select("doc", "list_no", "seq", "num_id", "level", "ordered", "marker", "parent_seq"))


def package_sections(spark, sf_dir):
    """Sections by the styles of headings, with the heading above."""
    s = written(views.sections(_ledgers(spark, sf_dir)))
    above = s.select("doc", F.col("section_id").alias("parent_id"), F.col("seq").alias("parent_seq"))
    return _of(s.join(above, ["doc", "parent_id"], "left").select("doc", "seq", "end_seq", "level", "title", "via", "confidence", "parent_seq"))


def package_captions(spark, sf_dir):
    n = _written(spark, sf_dir)
    # captions are paragraphs, what they tell of is an image or a table
    at = packages.table(n, "nodes").where(F.col("kind").isin("paragraph", "image", "table")).select("doc", F.col("node_id").alias("id"), "sequence", "kind")
    c = views.captions(n).join(at.select("doc", F.col("id").alias("caption_id"), F.col("sequence").alias("seq")), ["doc", "caption_id"])
    c = c.join(at.select("doc", F.col("id").alias("target_id"), F.col("sequence").alias("target_seq"), F.col("kind").alias("target_kind")), ["doc", "target_id"])
    return _of(c.select("doc", "seq", "target_seq", "target_kind", "confidence"))


def package_tables(spark, sf_dir):
    return _of(views.table_profiles(_written(spark, sf_dir)).select("doc", F.col("table").alias("seq"), "n_rows", "n_columns", "rectangular", "header_rows"))


def package_cells(spark, sf_dir):
    return _of(views.cells(_ledgers(spark, sf_dir)).select("doc", "table", "row", "column", "column_span", "original", "value", "marked", "declared"))


def package_chart_candidates(spark, sf_dir):
    return _of(views.chart_candidates(_written(spark, sf_dir)).select("doc", "table", "category_column", F.size("sources").alias("n_sources")))


def package_coverage(spark, sf_dir):
    """All ten features that are reconciled."""
    return _of(views.coverage(_parsed(spark, sf_dir, nodes=COUNTED, inventory=["feature", "value"])))


def package_inventory(spark, sf_dir):
    """What was counted in the parts, by feature."""
    rows = packages.table(_parsed(spark, sf_dir, inventory=[]), "inventory").groupBy("doc", "feature").agg(F.count("*").alias("n"), F.count_distinct("xml_path").alias("places"), F.count("target_part").alias("targets"))
    return _of(rows)


def package_health(spark, sf_dir):
    return _of(views.health(_parsed(spark, sf_dir, nodes=COUNTED, inventory=["feature", "value"], diagnostics=[])).select("doc", "filename", "state", "reason"))


def package_findings(spark, sf_dir):
    """What is wrong with the packages."""
    return _of(packages.table(_parsed(spark, sf_dir, diagnostics=[]), "diagnostics").select("doc", "code", "severity", "part_name", "relationship_id"))


def package_relationships(spark, sf_dir):
    r = packages.table(_parsed(spark, sf_dir, relationships=[]), "relationships")
    return _of(r.select("doc", "source_part", "relationship_id", "target", "mode", "target_part", "external_url", F.col("error").isNotNull().alias("refused")))


def package_parts(spark, sf_dir):
    return _of(packages.table(_parsed(spark, sf_dir, parts=[]), "parts"))


def package_assets(spark, sf_dir):
    """Documents by the assets that they show."""
    a = packages.table(_parsed(spark, sf_dir, assets=[]), "assets")
    return a.groupBy("asset_id", "mime_type", "byte_size", "extension").agg(F.count("*").alias("documents"), F.min(F.array_join("source_parts", ",")).alias("source_parts"))


def package_evidence(spark, sf_dir):
    """Evidence by document and kind, and how many sections it is placed in."""
    e = views.evidence(_written(spark, sf_dir))
    rows = e.groupBy("doc", "kind").agg(F.count("*").alias("n"), F.count_distinct("evidence_id").alias("different"), F.sum(F.size("sections")).alias("placed"))
    return _of(rows)


def package_violations(spark, sf_dir):
    """Rules that ledgers break, by rule: none, so each rule has nothing."""
    rules = spark.createDataFrame([(r,) for r in ("duplicate node", "missing parent", "missing asset", "missing source")], "rule string")
    found = views.violations(_written(spark, sf_dir, assets=["asset_id"])).groupBy("rule").agg(F.count("*").alias("n"))
    return rules.join(found, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("n"))


_LINES = r"""
x AS (SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]', '', 'g'), chr(10))) AS line,
      generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]', '', 'g'), chr(10)), 1) AS i FROM documents),
y AS (SELECT doc_id, line, length(line) AS n, length(line) % 8 AS m, length(line) // 8 AS step, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM x WHERE line <> ''),
l AS (SELECT *, CASE m WHEN 3 THEN 22 WHEN 6 THEN 3 ELSE 2 END AS size, coalesce(sum(CASE m WHEN 3 THEN 22 WHEN 6 THEN 3 ELSE 2 END) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + 1 AS seq FROM y),
total AS (SELECT d.doc_id, coalesce(max(seq + size), 1)::BIGINT AS stop FROM documents d LEFT JOIN l USING (doc_id) GROUP BY d.doc_id)"""


#: What stands where in a table of three rows: the places of its cells' paragraphs after its own, their row, column and text.
_CELLS = "unnest([{'at': 3, 'r': 0, 'c': 0, 't': 'Kind'}, {'at': 6, 'r': 0, 'c': 1, 't': 'Count'}, {'at': 10, 'r': 1, 'c': 0, 't': 't ' || line}, {'at': 13, 'r': 1, 'c': 1, 't': n::VARCHAR}, {'at': 17, 'r': 2, 'c': 0, 't': 'place'}, {'at': 20, 'r': 2, 'c': 1, 't': k::VARCHAR}]) AS cell"

NODES = f"""
WITH {_LINES}
SELECT doc_id AS doc_number, seq AS sequence, k - 1 AS sibling_index, CASE m WHEN 3 THEN 'table' ELSE 'paragraph' END AS kind,
       '/w:document/w:body[1]/w:' || CASE m WHEN 3 THEN 'tbl' ELSE 'p' END || '[' || row_number() OVER (PARTITION BY doc_id, m = 3 ORDER BY k) || ']' AS xml_path,
       CASE m WHEN 0 THEN 'Heading' || (step % 3 + 1) WHEN 2 THEN 'Caption' END AS style_id, CASE m WHEN 1 THEN '5' END AS num_id, CASE m WHEN 1 THEN step % 2 END AS list_level, seq + size - 1 AS subtree_end
FROM l"""

_ITEMS = "items AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run, step % 2 AS level FROM l WHERE m = 1)"
_BLOCKS = f"""
{_ITEMS},
b AS (SELECT doc_id, seq, CASE WHEN m = 0 THEN 'title' WHEN m = 3 THEN 'table' ELSE 'text' END AS kind,
             CASE WHEN m = 3 THEN 'KindCountt ' || line || n || 'place' || k WHEN m = 4 THEN '' WHEN m = 5 THEN '<eq>' || n || '</eq>' ELSE line END AS text, size AS n_sources, seq AS top FROM l WHERE m <> 1
      UNION ALL SELECT doc_id, seq + 1, CASE m WHEN 4 THEN 'image' ELSE 'equation' END, CASE m WHEN 5 THEN n::VARCHAR END, 1, seq FROM l WHERE m IN (4, 5)
      UNION ALL SELECT doc_id, seq + cell.at, 'text', cell.t, 2, seq FROM (SELECT *, {_CELLS} FROM l WHERE m = 3)
      UNION ALL SELECT doc_id, min(seq), 'list', string_agg(line, chr(10) ORDER BY k), count(*), min(seq) FROM items GROUP BY doc_id, run)"""
BLOCKS = f"""
WITH {_LINES}, {_BLOCKS}
SELECT doc_id AS doc_number, row_number() OVER (PARTITION BY doc_id ORDER BY seq, kind) AS place, kind, text, n_sources FROM b"""

LISTS = f"""
WITH {_LINES}, {_ITEMS}
SELECT a.doc_id AS doc_number, dense_rank() OVER (PARTITION BY a.doc_id ORDER BY a.run) AS list_no, a.seq, '5' AS num_id, a.level, a.level = 0 AS ordered, '%' || (a.level + 1) || '.' AS marker,
       (SELECT max(o.seq) FROM items o WHERE o.doc_id = a.doc_id AND o.run = a.run AND o.seq < a.seq AND o.level < a.level) AS parent_seq FROM items a"""

_HEADS = """
h AS (SELECT doc_id, seq, line, step % 3 + 1 AS level FROM l WHERE m = 0),
s AS (SELECT a.*, (SELECT max(o.seq) FROM h o WHERE o.doc_id = a.doc_id AND o.seq < a.seq AND o.level < a.level) AS parent_seq,
             coalesce((SELECT min(o.seq) FROM h o WHERE o.doc_id = a.doc_id AND o.seq > a.seq AND o.level <= a.level), t.stop) AS end_seq FROM h a JOIN total t USING (doc_id))"""
SECTIONS = f"""
WITH {_LINES}, {_HEADS}
SELECT doc_id AS doc_number, seq, end_seq, level, line AS title, 'style' AS via, 0.95::DOUBLE AS confidence, parent_seq FROM s"""

CAPTIONS = f"""
WITH {_LINES},
t AS (SELECT *, CASE m WHEN 3 THEN seq WHEN 4 THEN seq + 1 END AS target FROM l),
w AS (SELECT *, coalesce(lag(target) OVER (PARTITION BY doc_id ORDER BY k), lead(target) OVER (PARTITION BY doc_id ORDER BY k)) AS linked FROM t),
c AS (SELECT *, CASE WHEN m = 2 THEN 0.95 WHEN m IN (0, 1, 7) AND regexp_matches(line, '(?i)^\\s*(?:figure|fig\\.?|table|chart|image|圖|表)\\s*[0-9一二三四五六七八九十]*[.:：、\\-\\s]') THEN 0.75 END AS confidence FROM w)
SELECT c.doc_id AS doc_number, c.seq, c.linked AS target_seq, CASE o.m WHEN 3 THEN 'table' ELSE 'image' END AS target_kind, c.confidence::DOUBLE AS confidence
FROM c JOIN t o ON o.doc_id = c.doc_id AND o.target = c.linked WHERE c.confidence IS NOT NULL"""

TABLES = f"""
WITH {_LINES} SELECT doc_id AS doc_number, seq, 3::BIGINT AS n_rows, 2 AS n_columns, true AS rectangular, '0' AS header_rows FROM l WHERE m = 3"""
CELLS = f"""
WITH {_LINES}, c AS (SELECT *, {_CELLS} FROM l WHERE m = 3)
SELECT doc_id AS doc_number, seq AS "table", cell.r AS "row", cell.c AS "column", 1 AS column_span, cell.t AS original, CASE WHEN cell.c = 1 AND cell.r > 0 THEN try_cast(cell.t AS DOUBLE) END AS value, false AS marked, 2 AS declared FROM c"""
CANDIDATES = f"""
WITH {_LINES} SELECT doc_id AS doc_number, seq AS "table", 0 AS category_column, 6 AS n_sources FROM l WHERE m = 3"""

_RUNS = "CASE WHEN m = 3 THEN 6 WHEN m IN (4, 5) THEN 0 ELSE 1 END"
_CHARS = "CASE WHEN m = 3 THEN 16 + n + length(n::VARCHAR) + length(k::VARCHAR) WHEN m IN (4, 5) THEN 0 ELSE n END"
COVERAGE = f"""
WITH {_LINES},
c AS (SELECT d.doc_id, coalesce(sum({_RUNS}), 0) AS runs, coalesce(sum({_CHARS}), 0) AS chars, count(*) FILTER (m = 3) AS tables, count(*) FILTER (m = 4) AS images, count(*) FILTER (m = 5) AS equations, count(*) FILTER (m = 6) AS links
      FROM documents d LEFT JOIN l USING (doc_id) GROUP BY d.doc_id),
f AS (SELECT doc_id, unnest([{{'f': 'visible_text_nodes', 'n': runs}}, {{'f': 'visible_text_chars', 'n': chars}}, {{'f': 'image_blips', 'n': images}}, {{'f': 'tables', 'n': tables}}, {{'f': 'equations', 'n': equations}}, {{'f': 'hyperlinks', 'n': links}},
                            {{'f': 'charts', 'n': 0}}, {{'f': 'textboxes', 'n': 0}}, {{'f': 'structured_document_tags', 'n': 0}}, {{'f': 'field_hyperlinks', 'n': 0}}]) AS x FROM c)
SELECT doc_id AS doc_number, x.f AS feature, x.n::BIGINT AS source, x.n::BIGINT AS extracted, 0::BIGINT AS diagnosed, 0::BIGINT AS silent, 1.0::DOUBLE AS ratio FROM f"""
INVENTORY = f"""
WITH {_LINES},
c AS (SELECT doc_id, sum({_RUNS}) AS runs, sum(CASE m WHEN 3 THEN 6 ELSE 1 END) AS paragraphs, count(*) FILTER (m = 3) AS tables, count(*) FILTER (m = 4) AS images, count(*) FILTER (m = 5) AS equations, count(*) FILTER (m = 6) AS links FROM l GROUP BY doc_id),
f AS (SELECT doc_id, unnest([{{'f': 'visible_text_nodes', 'n': runs, 't': 0}}, {{'f': 'visible_text_chars', 'n': runs, 't': 0}}, {{'f': 'paragraphs', 'n': paragraphs, 't': 0}}, {{'f': 'tables', 'n': tables, 't': 0}}, {{'f': 'drawings', 'n': images, 't': 0}},
                            {{'f': 'image_blips', 'n': images, 't': images}}, {{'f': 'equations', 'n': equations, 't': 0}}, {{'f': 'hyperlinks', 'n': links, 't': 0}}]) AS x FROM c)
SELECT doc_id AS doc_number, x.f AS feature, x.n::BIGINT AS n, x.n::BIGINT AS places, x.t::BIGINT AS targets FROM f WHERE x.n > 0"""

HEALTH = "SELECT doc_id AS doc_number, doc_id || '.docx' AS filename, 'ready' AS state, NULL::VARCHAR AS reason FROM documents"
FINDINGS = """
SELECT doc_id AS doc_number, CASE doc_id % 3 WHEN 1 THEN 'MISSING_RELATIONSHIP_TARGET' ELSE 'UNSAFE_RELATIONSHIP_TARGET' END AS code, 'warning' AS severity, 'word/document.xml' AS part_name, 'rId3' AS relationship_id
FROM documents WHERE doc_id % 3 > 0"""
RELATIONSHIPS = """
SELECT doc_id AS doc_number, 'word/document.xml' AS source_part, 'rId' || k AS relationship_id, CASE WHEN k = 2 THEN 'http://example.org/' WHEN k = 1 OR doc_id % 3 = 0 THEN 'media/a.gif' WHEN doc_id % 3 = 1 THEN 'media/none.gif' ELSE '../../out.gif' END AS target,
       CASE k WHEN 2 THEN 'External' ELSE 'Internal' END AS mode, CASE WHEN k = 2 THEN NULL WHEN k = 1 OR doc_id % 3 = 0 THEN 'word/media/a.gif' WHEN doc_id % 3 = 1 THEN 'word/media/none.gif' END AS target_part,
       CASE k WHEN 2 THEN 'http://example.org/' END AS external_url, k = 3 AND doc_id % 3 = 2 AS refused
FROM documents, unnest([1, 2, 3]) AS u(k)"""
PARTS = "SELECT doc_id AS doc_number, 'word/document.xml' AS part_name, 'application/xml' AS content_type, 3 AS relationship_count FROM documents"
ASSETS = f"""
WITH {_LINES}
SELECT 'asset-' || sha256(unhex('{_PIXEL.hex()}')) AS asset_id, 'image/gif' AS mime_type, {len(_PIXEL)}::BIGINT AS byte_size, '.gif' AS extension, count(DISTINCT doc_id) AS documents, 'word/media/a.gif' AS source_parts FROM l WHERE m = 4 HAVING count(*) > 0"""
EVIDENCE = f"""
WITH {_LINES}, {_HEADS}, {_BLOCKS},
e AS (SELECT doc_id, kind, top FROM b UNION ALL SELECT doc_id, 'chart_candidate', top FROM b WHERE kind = 'table')
SELECT e.doc_id AS doc_number, e.kind, count(*) AS n, count(*) AS different, sum((SELECT count(*) FROM s WHERE s.doc_id = e.doc_id AND s.seq <= e.top AND e.top < s.end_seq))::BIGINT AS placed FROM e GROUP BY e.doc_id, e.kind"""
VIOLATIONS = "SELECT unnest(['duplicate node', 'missing parent', 'missing asset', 'missing source']) AS rule, 0::BIGINT AS n"

QUERIES = {
    "package_nodes": (package_nodes, NODES),
    "package_blocks": (package_blocks, BLOCKS),
    "package_lists": (package_lists, LISTS),
    "package_sections": (package_sections, SECTIONS),
    "package_captions": (package_captions, CAPTIONS),
    "package_tables": (package_tables, TABLES),
    "package_cells": (package_cells, CELLS),
    "package_chart_candidates": (package_chart_candidates, CANDIDATES),
    "package_coverage": (package_coverage, COVERAGE),
    "package_inventory": (package_inventory, INVENTORY),
    "package_health": (package_health, HEALTH),
    "package_findings": (package_findings, FINDINGS),
    "package_relationships": (package_relationships, RELATIONSHIPS),
    "package_parts": (package_parts, PARTS),
    "package_assets": (package_assets, ASSETS),
    "package_evidence": (package_evidence, EVIDENCE),
    "package_violations": (package_violations, VIOLATIONS),
}
