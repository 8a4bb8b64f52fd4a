"""Every reference that was generated must lead to evidence: flattened into rows and anti-joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docledger.planning.contracts import CITING, digest_references, slides

REFS = "origin string, doc_id string, evidence_id string"


class ProvenanceError(ValueError):
    pass


def rows_of(origin: str, references: list[dict]) -> list[tuple[str, str, str]]:
    return [(origin, r["doc_id"], e) for r in references for e in r["evidence_ids"]]


def digest_rows(digests: list[dict]) -> list[tuple]:
    return [row for d in digests for row in rows_of(f"digest {d['doc_id']}", digest_references(d))]


def selection_rows(selection: dict) -> list[tuple]:
    return [("selection", s["doc_id"], s["evidence_id"]) for s in selection["selected"]]


def outline_rows(outline: dict) -> list[tuple]:
    return [row for s in slides(outline) for row in rows_of(f"slide {s['slide_id']}", s["evidence"])]


class Corpus:
    """The evidence that may be cited: rows of doc_id and evidence_id, one set of them for each document."""

    def __init__(self, evidence: DataFrame, documents: DataFrame | None = None):
        self.evidence = evidence.select("doc_id", "evidence_id")
        twice = self.evidence.groupBy("doc_id", "evidence_id").count().where("count > 1").head()
        if twice:
            raise ProvenanceError(f"document {twice[0]!r} contains duplicate evidence {twice[1]!r}")
        if documents is not None:
            again = documents.groupBy("doc_id").count().where("count > 1").head()
            if again:
                raise ProvenanceError(f"duplicate artifact for {again[0]!r}")
        self.documents = (documents if documents is not None else evidence).select("doc_id").distinct()
        self.spark: SparkSession = evidence.sparkSession

    def unresolved(self, rows: list[tuple]) -> DataFrame:
        """origin, doc_id, evidence_id of references that lead nowhere."""
        return self.spark.createDataFrame(rows, REFS).join(self.evidence, ["doc_id", "evidence_id"], "left_anti").select("origin", "doc_id", "evidence_id")

    def check(self, rows: list[tuple], named: list[str] = ()) -> None:
        """Raise for the first reference, or named document, that does not resolve."""
        names = sorted({*named, *(r[1] for r in rows)})
        if names:
            lost = self.spark.createDataFrame([(n,) for n in names], "doc_id string").join(self.documents, "doc_id", "left_anti").orderBy("doc_id").head()
            if lost:
                raise ProvenanceError(f"unknown document ID {lost[0]!r}")
        if rows and (lost := self.unresolved(rows).orderBy("origin", "doc_id", "evidence_id").head()):
            raise ProvenanceError(f"{lost[0]}: unknown evidence ID {lost[2]!r} for document {lost[1]!r}")

    def check_digests(self, digests: list[dict]) -> None:
        names = [d["doc_id"] for d in digests]
        for d in digests:
            if names.count(d["doc_id"]) > 1:
                raise ProvenanceError(f"duplicate digest for document {d['doc_id']!r}")
            if any(r["doc_id"] != d["doc_id"] for r in digest_references(d)):
                raise ProvenanceError(f"digest {d['doc_id']!r} references evidence from another document")
        self.check(digest_rows(digests), names)

    def check_selection(self, selection: dict) -> None:
        self.check(selection_rows(selection))

    def check_outline(self, outline: dict) -> None:
        for s in slides(outline):
            if s["purpose"] in CITING and not s["evidence"]:
                raise ProvenanceError(f"{s['purpose']} slide {s['slide_id']!r} must include evidence")
        self.check(outline_rows(outline))
