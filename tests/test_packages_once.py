"""Packages are read once a query, over all cores, and views need no rows of a ledger brought together."""

import random

import pytest
from docledger.operators import views
from docledger.plans import packages as plans
from docledger.plans import registry
from docledger.sources import opc, packages
from docledger.sources.docx import read_package

from tests.docx_factory import IMAGE, NUMBERS, PNG, STYLES, box, image, numbered, p, package, t, tbl


def body(rng, depth=0):
    heading = '<w:pStyle w:val="{}"/>'
    kinds = [
        lambda: p(t("Head"), heading.format(rng.choice(["Heading1", "Heading2", "Heading3", "heading", "Titre2", "Titre", "MyHeading"]))),
        lambda: numbered("item", 5, rng.randrange(3)),
        lambda: p(t("Figure 1: x")),
        lambda: tbl(["Month", "Sales"], ["Jan", "1,200"], ["Feb", rng.choice(["1300", "x"])]),
        lambda: p(image(rng.choice(["rId1", "rId9"]))),
        lambda: p(t("a ") + "<m:oMath><m:r><m:t>x</m:t></m:r></m:oMath>"),
        lambda: p(box(body(rng, depth + 1))) if depth < 2 else p(t("plain")),
    ]
    return "".join(rng.choice(kinds)() for _ in range(rng.randrange(1, 12 - 4 * depth)))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    members = {"word/media/a.png": PNG, "word/styles.xml": STYLES, "word/numbering.xml": NUMBERS}
    rows = [(f"{k}.docx", package(body(rng), members, [("rId1", *IMAGE, "")])) for k in range(30)] + [("bad.docx", b"no package")]
    return packages.parse(spark.createDataFrame(rows, "path string, content binary")).cache()


@pytest.mark.parametrize("view", ["blocks", "lists", "list_items", "sections", "captions", "cells", "table_profiles", "chart_candidates", "evidence"])
def test_views_of_documents_are_those_of_their_nodes(corpus, view):
    rows, whole = (getattr(views, view)(x) for x in (packages.table(corpus, "nodes"), corpus))
    assert rows.count() > 0 and sorted(map(str, rows.collect())) == sorted(map(str, whole.select(rows.columns).collect()))


def test_sections_reach_to_the_next_heading_of_their_level(corpus):
    for r in corpus.where("error is null").collect():
        levels = {"heading": 1, "Heading1": 1, "Heading2": 2, "Heading3": 3, "Titre2": 2}
        heads = [(n.sequence, levels[n.style_id]) for n in r.nodes if n.kind == "paragraph" and n.style_id in levels]
        want = []
        for s, level in heads:
            above = [x for x, k in heads if x < s and k < level]
            want.append((s, min([x for x, k in heads if x > s and k <= level], default=len(r.nodes)), level, above[-1] if above else None))
        rows = views.sections(corpus.where(corpus.doc == r.doc)).collect()
        seq = {x.section_id: x.seq for x in rows}
        assert sorted((x.seq, x.end_seq, x.level, seq.get(x.parent_id)) for x in rows) == want
        if r.doc == "4.docx":
            break


def test_each_part_is_parsed_once(monkeypatch):
    parsed, parse = [], opc.parse
    monkeypatch.setattr(opc, "parse", lambda data: parsed.append(data) or parse(data))
    read_package(plans.package(1, "a heading here\nand more of it"), "x.docx")
    assert len(parsed) == len(set(parsed)) == 5


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_a_query_reads_its_packages_once(spark, sf_dir, name):
    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") <= 2  # one writes packages, the other reads them


def test_packages_are_dealt_out_over_all_cores(spark, sf_dir):
    assert plans.files(plans.table(spark, sf_dir, "documents")).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_only_the_lists_that_are_wanted_are_given(spark, corpus):
    files = spark.createDataFrame([("a.docx", plans.package(1, "x"))], "path string, content binary")
    some = packages.parse(files, only={"parts": [], "nodes": ["kind", "payload"]})
    whole = packages.parse(files).first()
    row = some.first()
    assert some.columns == ["doc", "filename", "doc_id", "sha256", "error_type", "error", "nodes", "parts"]
    assert [tuple(n) for n in row.nodes] == [(n.kind, n.payload) for n in whole.nodes] and row.parts == whole.parts and row.doc_id == whole.doc_id
