"""Contracts, references, and whole runs with a made-up generator."""

import asyncio
import copy
import json

import pytest
from docledger import api, cli
from docledger.planning import contracts, provenance, service
from docledger.sources import packages
from docledger.streaming import ingest

from tests.docx_factory import IMAGE, PNG, image, p, package, t, tbl

WISH = {"goal": "inform", "audience": "all", "target_slide_count": 3}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("plan")
    (at / "a.docx").write_bytes(package(p(t("Alpha"), '<w:pStyle w:val="Heading1"/>') + p(t("fact one")) + p(image()), {"word/media/a.png": PNG}, [("rId1", *IMAGE, "")]))
    (at / "b.docx").write_bytes(package(p(t("Beta")) + tbl(["x", "y"], ["u", "2"])))
    return at


class Fake:
    """Answers from what it is shown; bad makes its first outline cite what is not there."""

    def __init__(self, bad=False, wrong=False):
        self.bad, self.wrong, self.prompts, self.now, self.most = bad, wrong, [], 0, 0

    async def generate(self, *, system_prompt, input_data, response_model):
        self.prompts.append((system_prompt, input_data))
        self.now += 1
        self.most = max(self.most, self.now)
        await asyncio.sleep(0.01)
        self.now -= 1
        if response_model is contracts.DIGEST:
            d = input_data["document"]["doc_id"]
            ref = {"doc_id": d, "evidence_ids": [input_data["evidence"][0]["evidence_id"]]}
            return {"doc_id": "doc-x" if self.wrong else d, "summary": "s", "key_facts": [{"claim": "c", "evidence": [ref]}]}
        if response_model is contracts.SELECTION:
            return {"items": [{"doc_id": c["doc_id"], "evidence_id": c["evidence"][0]["evidence_id"], "reason": "r"} for c in input_data["evidence_catalogue"]]}
        cited = [{"doc_id": e["doc_id"], "evidence_ids": ["gone" if self.bad and "refused" not in system_prompt else e["evidence_id"]]} for e in input_data["selected_evidence"]]
        slide = {"slide_id": "1", "title": "t", "purpose": "content", "message": "m", "evidence": cited}
        return {"title": "T", "objective": "o", "narrative": "n", "sections": [{"section_id": "s", "title": "t", "purpose": "p", "slides": [slide]}]}


def run(spark, folder, generator, **more):
    return asyncio.run(service.generate_outline(spark, str(folder), WISH, generator, **more))


def test_outline_and_one_repair(spark, folder):
    good = Fake()
    outline = run(spark, folder, good)
    assert len(contracts.slides(outline)[0]["evidence"]) == 2 and len(good.prompts) == 4
    told = json.dumps([x for _, x in good.prompts])
    assert '\\"series\\":\\"y=2\\"' in told
    assert not any(word in told for word in ("node-", "view-f", "xml_path", "word/document.xml", "block_id"))
    bad = Fake(bad=True)
    assert run(spark, folder, bad) == outline and len(bad.prompts) == 5 and "unknown evidence ID 'gone'" in bad.prompts[-1][0]
    with pytest.raises(ValueError, match="instead of"):
        run(spark, folder, Fake(wrong=True))


def test_bad_documents_end_the_run(spark, folder, tmp_path):
    (tmp_path / "x.docx").write_bytes(b"nothing")
    with pytest.raises(service.BatchError) as e:
        run(spark, tmp_path, Fake())
    assert e.value.failures[0]["filename"] == "x.docx"


def test_digests_keep_order_and_bound(folder):
    shown = [{"document": {"doc_id": f"d{k}"}, "evidence": [{"evidence_id": "e"}]} for k in range(9)]
    fake = Fake()
    got = asyncio.run(service.make_digests(shown, fake, 3))
    assert [d["doc_id"] for d in got] == [f"d{k}" for k in range(9)] and fake.most <= 3
    for wrong in (0, -1, True, 1.5, "2"):
        with pytest.raises(ValueError):
            asyncio.run(service.make_digests(shown, fake, wrong))


def test_references_that_lead_nowhere(spark):
    corpus = provenance.Corpus(spark.createDataFrame([("d", "e1"), ("d", "e2"), ("f", "e3")], "doc_id string, evidence_id string"))
    ref = lambda d, *e: {"doc_id": d, "evidence_ids": list(e)}
    digest = lambda d, r: {"doc_id": d, "summary": "s", "topics": [], "key_facts": [{"claim": "c", "evidence": [r]}]}
    corpus.check_digests([digest("d", ref("d", "e1", "e2")), digest("f", ref("f", "e3"))])
    for digests, said in (([digest("d", ref("d", "e3"))], "unknown evidence"), ([digest("z", ref("z", "e1"))], "unknown document"), ([digest("d", ref("f", "e3"))], "another document"), ([digest("d", ref("d", "e1"))] * 2, "duplicate digest")):
        with pytest.raises(provenance.ProvenanceError, match=said):
            corpus.check_digests(digests)
    slide = {"slide_id": "1", "purpose": "summary", "evidence": []}
    with pytest.raises(provenance.ProvenanceError, match="must include evidence"):
        corpus.check_outline({"sections": [{"slides": [slide]}]})
    corpus.check_outline({"sections": [{"slides": [{**slide, "purpose": "title"}]}]})
    with pytest.raises(provenance.ProvenanceError, match="duplicate evidence"):
        provenance.Corpus(spark.createDataFrame([("d", "e"), ("d", "e")], "doc_id string, evidence_id string"))


def test_contracts_are_closed():
    ok = {"doc_id": "d", "evidence_ids": ["e"]}
    assert contracts.REFERENCE(ok) == ok
    for bad in ({**ok, "more": 1}, {"doc_id": " ", "evidence_ids": ["e"]}, {"doc_id": "d", "evidence_ids": []}, {"doc_id": "d", "evidence_ids": ["e", "e"]}, {"doc_id": "d"}, "d"):
        with pytest.raises(contracts.ContractError):
            contracts.REFERENCE(bad)
    for n in (0, 101, True, "3"):
        with pytest.raises(contracts.ContractError):
            contracts.REQUIREMENTS({**WISH, "target_slide_count": n})
    s = {"doc_id": "d", "evidence_id": "e", "reason": "r"}
    assert contracts.SELECTION({"selections": [s]})["selected"] == [s]
    with pytest.raises(contracts.ContractError):
        contracts.SELECTION({"selected": [s, s]})
    a = {"doc_id": "d", "filename": "f", "artifact_uri": "u"}
    with pytest.raises(contracts.ContractError):
        contracts.MANIFEST({"corpus_id": "c", "documents": [a, a]})


def test_artifacts_repeat_to_the_byte_and_the_command_line_tells(spark, folder, tmp_path):
    one, two = tmp_path / "one.json", tmp_path / "sub" / "two.json"
    assert cli.run(["extract", str(folder / "a.docx"), "--output", str(one), "--assets-dir", str(tmp_path / "assets"), "--log-file", str(tmp_path / "log")], spark) == 0
    assert cli.run(["extract", str(folder / "a.docx"), "--output", str(two)], spark) == 0
    assert one.read_bytes() == two.read_bytes() and [x.suffix for x in (tmp_path / "assets").iterdir()] == [".png"]
    assert "fact one" not in (tmp_path / "log").read_text()
    artifact = json.loads(one.read_text())
    assert artifact["document"]["filename"] == "a.docx" and artifact["extractor_version"] == "0.2.0"
    assert cli.run(["validate", str(one)]) == 0
    for spoiled in ({k: v for k, v in artifact.items() if k != "nodes"}, {**artifact, "document": {}}, {**artifact, "nodes": artifact["nodes"] * 2}, {**artifact, "schema_version": "0"}, [], {**artifact, "nodes": artifact["nodes"][::-1]}, {**artifact, "nodes": artifact["nodes"][1:]}):
        two.write_text(json.dumps(spoiled))
        with pytest.raises(SystemExit):
            cli.run(["validate", str(two)])
    log = tmp_path / "log.json"
    assert cli.run(["extract", str(folder / "a.docx"), "--output", str(tmp_path / 'a "b".json'), "--log-file", str(log), "--log-json"], spark) == 0
    assert all(json.loads(line)["level"] == "INFO" for line in log.read_text().splitlines())
    lost = copy.deepcopy(artifact)
    lost["coverage"][0]["silent"] = 1
    one.write_text(json.dumps(lost))
    assert cli.run(["validate", str(one)]) == 1
    with pytest.raises(ValueError):
        (tmp_path / "bad.docx").write_bytes(b"x")
        api.extract(spark, str(tmp_path / "bad.docx"))


def test_corpora_manifests_and_classification(spark, folder, tmp_path):
    documents = packages.read(spark, str(folder))
    manifest = api.write_corpus(documents, str(tmp_path / "c"))
    rows = spark.read.json(manifest["manifest"]).orderBy("filename").collect()
    assert [(d.filename, d.corpus_id, d.health) for d in rows] == [("a.docx", manifest["corpus_id"], rows[0].health), ("b.docx", manifest["corpus_id"], rows[1].health)]
    assert spark.read.parquet(str(tmp_path / "c" / "nodes")).count() == packages.table(documents, "nodes").count()

    class Classifier:
        classifier_version, prompt_version = "c1", "p1"

        def classify(self, asset):
            return {"relevance": "high", "decorative": False, "confidence": 0.5}

    first = api.classify(packages.table(documents, "assets"), Classifier()).cache()
    assert [(r.relevance, r.error) for r in first.collect()] == [("high", None)]

    class Broken(Classifier):
        def classify(self, asset):
            raise RuntimeError("asked again")

    assert [r.relevance for r in api.classify(packages.table(documents, "assets"), Broken(), first).collect()] == ["high"]
    assert [r.error for r in api.classify(packages.table(documents, "assets"), Broken()).collect()] == ["asked again"]


def test_files_that_arrive_are_read_once(spark, folder, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.docx").write_bytes((folder / "a.docx").read_bytes())
    ingest.ingest(spark, str(source), str(out)).awaitTermination()
    (source / "b.docx").write_bytes((folder / "b.docx").read_bytes())
    ingest.ingest(spark, str(source), str(out)).awaitTermination()
    assert sorted(r.filename for r in ingest.documents(spark, str(out)).collect()) == ["a.docx", "b.docx"]
