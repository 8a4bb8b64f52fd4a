"""Views over parsed packages, from files to evidence."""

import random
from datetime import date

import pytest
from docledger import ids
from docledger.functions import values
from docledger.operators import hierarchy, ledger, views
from docledger.sources import packages
from pyspark.sql import functions as F

from tests.docx_factory import IMAGE, NUMBERS, PNG, STYLES, image, numbered, p, package, t, tbl


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    members = {"word/media/a.png": PNG, "word/styles.xml": STYLES, "word/numbering.xml": NUMBERS}
    pictures = [("rId1", *IMAGE, "")]
    heading = '<w:pStyle w:val="{}"/>'
    equation = "<m:oMath><m:r><m:t>x</m:t></m:r></m:oMath>"
    body = (
        p(t("Report"), heading.format("Heading1")) + p(t("Intro ") + equation) + numbered("North region", 5, 0) + numbered("Detail", 5, 1) + numbered("Enterprise", 5, 0)
        + p(t("Numbers"), heading.format("Heading3")) + tbl(["Month", "Sales"], ["Jan", "1,200"], ["Feb", "1300"]) + p(t("Table 1: sales")) + p(image()) + p(t("The image"), heading.format("Caption")) + tbl(["a", "b"], ["c"]) + "<w:altChunk/>"
    )
    (folder / "a.docx").write_bytes(package(body, members, pictures))
    (folder / "b.docx").write_bytes(package(p(t("plain"))))
    (folder / "c.docx").write_bytes(b"no package")
    (folder / "d.docx").write_bytes(package(p(image("rId9"))))
    (folder / "e.docx").write_bytes(package(p("<m:oMathPara>" + equation + equation + "</m:oMathPara>")))
    (folder / "f.txt").write_bytes(b"another file")
    return packages.read(spark, str(folder)).withColumn("doc", F.col("filename")).cache()


@pytest.fixture(scope="module")
def nodes(corpus):
    return packages.table(corpus, "nodes").cache()


def of(df, doc="a.docx"):
    return df.where(F.col("doc") == doc)


def test_bad_files_are_rows(corpus):
    rows = {r.filename: r for r in corpus.collect()}
    assert set(rows) == {"a.docx", "b.docx", "c.docx", "d.docx", "e.docx"} and rows["c.docx"].error_type == "ValueError" and rows["a.docx"].error is None
    states = {r.filename: r.state for r in views.health(corpus).collect()}
    assert states == {"a.docx": "ready", "b.docx": "ready", "c.docx": "failed", "d.docx": "failed", "e.docx": "degraded"}


def test_blocks(nodes):
    rows = of(views.blocks(nodes)).orderBy("seq").collect()
    assert [(r.kind, r.text) for r in rows][:5] == [("title", "Report"), ("text", "Intro <eq>x</eq>"), ("equation", "x"), ("list", "North region\nDetail\nEnterprise"), ("title", "Numbers")]
    table = next(r for r in rows if r.kind == "table")
    assert table.text == "MonthSalesJan1,200Feb1300" and sum(r.kind == "text" and r.text == "Month" for r in rows) == 1
    for r in rows:
        assert r.block_id == ids.view_id_py("semantic-blocks", "1.0.0", ids.CONFIG, r.sources) and len(r.sources) == len(r.source_seqs)
    assert [r.kind for r in rows][-1] == "unsupported"


def test_lists(nodes):
    items = of(views.list_items(nodes)).orderBy("seq").collect()
    assert [(i.level, i.ordered, i.parent_seq and i.parent_seq == items[0].seq) for i in items] == [(0, True, None), (1, False, True), (0, True, None)]
    one = of(views.lists(nodes)).collect()
    assert len(one) == 1 and one[0].list_id == ids.view_id_py("lists", "1.0.0", {}, [i.node_id for i in items])


def test_sections(nodes):
    rows = of(views.sections(nodes)).orderBy("seq").collect()
    assert [(r.title, r.level, r.via, r.confidence) for r in rows] == [("Report", 1, "outline_level", 1.0), ("Numbers", 3, "outline_level", 1.0)]
    assert rows[1].parent_id == rows[0].section_id and rows[0].parent_id is None
    everything = [r.node_id for r in of(nodes).orderBy("sequence").collect()]
    assert rows[0].section_id == ids.view_id_py("sections", "1.0.0", {"level": 1, "via": "outline_level"}, everything[rows[0].seq : rows[0].end_seq])


def test_captions(nodes):
    by_id = {r.node_id: r for r in nodes.collect()}
    found = [(by_id[r.target_id].kind, r.confidence) for r in of(views.captions(nodes)).orderBy("confidence").collect()]
    assert found == [("table", 0.75), ("image", 0.95)]


def test_tables(nodes):
    rows = of(views.table_profiles(nodes)).orderBy("table").collect()
    assert [(r.n_rows, r.n_columns, r.rectangular, r.header_rows) for r in rows] == [(3, 2, True, "0"), (2, 2, False, "")]
    drawn = of(views.chart_candidates(nodes)).collect()
    assert [(r.category_column, r.categories, r.series) for r in drawn] == [(0, "Jan,Feb", "Sales=1,200,1300")]
    assert drawn[0].candidate_id == ids.view_id_py("table-profiler", "1.0.0", {"category_column": 0}, drawn[0].sources)
    assert [r.value for r in of(views.cells(nodes)).where("value is not null").orderBy("seq" if False else "row").collect()] == [1200.0, 1300.0]


def test_coverage_and_checks(corpus):
    rows = {(r.doc, r.feature): r for r in views.coverage(corpus).collect()}
    assert rows["a.docx", "visible_text_chars"].ratio == 1.0 and rows["a.docx", "tables"].source == 2
    assert (rows["e.docx", "equations"].source, rows["e.docx", "equations"].extracted, rows["e.docx", "equations"].silent) == (2, 1, 1)
    assert (rows["d.docx", "image_blips"].diagnosed, rows["d.docx", "image_blips"].silent) == (1, 0)
    assert views.violations(corpus).count() == 0


def test_evidence_and_index(nodes):
    rows = of(views.evidence(nodes)).orderBy("seq", "rank").collect()
    kinds = [r.kind for r in rows]
    assert "unsupported" not in kinds and kinds.count("chart_candidate") == 1 and kinds[kinds.index("chart_candidate") - 1] == "table"
    for r in rows:
        how = "table-profile" if r.kind == "chart_candidate" else "primary"
        assert r.evidence_id == ids.pipeline_id_py("evidence", r.doc_id, "1.0.0", r.kind, r.block_id, how, r.sources)
    sections = of(views.indexed_sections(nodes)).orderBy("seq").collect()
    assert sections[0].evidence_ids == [r.evidence_id for r in rows] and set(sections[1].evidence_ids) < set(sections[0].evidence_ids)
    assert all(len(r.sections) in (1, 2) for r in rows)


def test_partitions_do_not_change_views(spark, corpus, nodes):
    before = [tuple(r) for r in views.evidence(nodes).orderBy("doc", "seq", "rank").select("evidence_id", "text").collect()]
    again = packages.table(corpus.repartition(3), "nodes").repartition(5, "kind")
    assert [tuple(r) for r in views.evidence(again).orderBy("doc", "seq", "rank").select("evidence_id", "text").collect()] == before


# windows against plain versions on random ledgers


def test_nesting_and_sections_on_random_headings(spark):
    rng = random.Random(6)
    rows = [(d, s, rng.randrange(1, 10)) for d in range(12) for s in range(rng.randrange(60))]
    got = {(r.d, r.seq): (r.parent_seq, r.end_seq) for r in hierarchy.sections(spark.createDataFrame(rows, "d int, seq long, level int"), ["d"]).collect()}
    for d, s, level in rows:
        before = [x for e, x, k in rows if e == d and x < s and k < level]
        after = [x for e, x, k in rows if e == d and x > s and k <= level]
        assert got[d, s] == (max(before, default=None), min(after, default=None))


def test_lists_on_random_ledgers(spark):
    rng = random.Random(7)
    rows = [(d, s, rng.choice(["paragraph", "paragraph", "paragraph", "table"]), rng.choice([None, "1", "2"]), rng.choice("xy")) for d in range(20) for s in range(40)]
    frame = spark.createDataFrame(rows, "d int, seq long, kind string, num string, parent string")
    got = {}
    for r in hierarchy.lists(frame, ["d"], "seq", (F.col("kind") == "paragraph") & F.col("num").isNotNull(), ["num", "parent"]).collect():
        got.setdefault((r.d, r.list_no), []).append(r.seq)
    want, n = {}, 0
    for d in range(20):
        last, n = None, 0
        for _, s, kind, num, parent in sorted(r for r in rows if r[0] == d):
            item = kind == "paragraph" and num is not None
            if item:
                n += last != (num, parent)
                want.setdefault((d, n), []).append(s)
            last = (num, parent) if item else None
    assert {k: sorted(v) for k, v in got.items()} == want


@pytest.mark.parametrize(
    ("facts", "want"),
    [
        ((0, None, None), (True, 1, "outline_level", 1.0)), ((8, None, None), (True, 9, "outline_level", 1.0)), ((9, None, None), (False, None, None, None)), ((None, "Heading 3", None), (True, 3, "style", 0.95)),
        ((None, "HeadingX", None), (True, 1, "style", 0.85)), ((None, "Titre2", None), (True, 2, "style", 0.85)), ((None, "Titre", None), (True, None, None, None)), ((None, "x", "heading 12"), (True, 1, "style", 0.85)),
        ((None, "Titre", "heading 4"), (True, 4, "style", 0.95)), ((None, "Normal", None), (False, None, None, None)),
    ],
)
def test_headings(spark, facts, want):
    frame = spark.createDataFrame([facts], "o int, i string, n string")
    assert tuple(frame.select(hierarchy.heading_of(F.col("o"), F.col("i"), F.col("n")).alias("h")).first().h) == want


NUMBERS_READ = {"1,200": 1200.0, " +5.5 ": 5.5, "50%": 0.5, "100 USD": 100.0, "7€": 7.0, "$100": None, ".5": None, "5.": None, "1e5": None, "(5)": None, "1,20": None, "": None, "12 %": 0.12, "-3": -3.0}
DATES_READ = {
    "2024-01-31": date(2024, 1, 31), "2024/01/31": date(2024, 1, 31), "20240131": date(2024, 1, 31), "2024-W01-1": date(2024, 1, 1), "2024W011": date(2024, 1, 1), "2024-W01": date(2024, 1, 1), "2020-W53-7": date(2021, 1, 3),
    "2024-W53-1": None, "2024-1-2": None, "2024": None, "2024-001": None, "2024-0102": None, "0000-01-01": None, "2024-02-30": None, " 2024-02-29 ": date(2024, 2, 29), "2024-W00": None,
}


def test_numbers_and_dates(spark):
    frame = spark.createDataFrame([(k,) for k in [*NUMBERS_READ, *DATES_READ]], "x string")
    got = {r.x: (r.n, r.d) for r in frame.select("x", values.number(F.col("x")).alias("n"), values.iso_date(F.col("x")).alias("d")).collect()}
    assert {k: got[k][0] for k in NUMBERS_READ} == NUMBERS_READ
    assert {k: got[k][1] for k in DATES_READ} == DATES_READ


def test_chains_with_a_circle(spark):
    rows = [("a", "b", None, 1), ("b", "c", None, None), ("c", "a", "n", None), ("d", "gone", None, None), ("e", None, "m", 2)]
    got = {r.k: (r.name, r.level) for r in ledger.chain(spark.createDataFrame(rows, "k string, up string, name string, level int"), "k", "up", ["name", "level"]).collect()}
    assert got == {"a": ("n", 1), "b": ("n", 1), "c": ("n", 1), "d": (None, None), "e": ("m", 2)}
