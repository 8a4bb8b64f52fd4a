"""Whole documents: one package as a canonical artifact, corpora as tables, assets as files."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger import ids
from docledger.lineage import written
from docledger.operators import views
from docledger.planning import contracts
from docledger.sources import packages

#: Versions that artifacts carry.
SCHEMA_VERSION, EXTRACTOR_VERSION = "1.0.0", "0.2.0"


def artifacts(documents: DataFrame) -> DataFrame:
    """doc, artifact: each document, its ledger and its views as one canonical JSON text."""
    n = packages.table(documents, "nodes")

    def listed(rows: DataFrame, order: list[str], into: str) -> DataFrame:
        columns = [c for c in rows.columns if c not in ("doc", "doc_id")]
        return rows.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in columns if c not in order]))).alias(into))

    parts = {
        "blocks": listed(views.blocks(n), ["seq", "block_id"], "blocks"),
        "sections": listed(views.sections(n), ["seq"], "sections"),
        "caption_links": listed(views.captions(n), ["caption_id"], "caption_links"),
        "coverage": listed(views.coverage(documents), ["feature"], "coverage"),
        "evidence": listed(views.evidence(n), ["seq", "rank"], "evidence"),
    }
    out = documents
    for rows in parts.values():
        out = out.join(rows, "doc", "left")
    bare = F.transform("assets", lambda a: a.dropFields("data"))
    record = F.struct(
        bare.alias("assets"), *sorted(parts), "diagnostics", F.struct("doc_id", "filename", "sha256", F.col("sha256").alias("sanitized_sha256")).alias("document"), F.lit(EXTRACTOR_VERSION).alias("extractor_version"),
        "inventory", "nodes", "parts", "relationships", F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
    return out.where("error_type is null").select("doc", F.to_json(record, {"ignoreNullFields": "false"}).alias("artifact"))


def extract(spark: SparkSession, path: str, *, with_assets: bool = False):
    """The artifact of one package; with_assets: also the bytes of its assets by file name."""
    documents = packages.read(spark, path, "*").persist()
    try:
        found = documents.select("error_type", "error").first()
        if found is None or found.error_type:
            raise ValueError(found.error if found else f"no file at {path}")
        artifact = json.loads(artifacts(documents).first().artifact)
        if not with_assets:
            return artifact
        rows = packages.table(documents, "assets").select("asset_id", "extension", "data").dropDuplicates(["asset_id"])
        return artifact, {r.asset_id + r.extension: bytes(r.data) for r in rows.toLocalIterator()}  # one package's
    finally:
        documents.unpersist()


#: The shape of an artifact: what each list's rows must hold, and of which kind.
_TEXT, _NUMBER = (str,), (int,)
SHAPE = {
    "assets": {"asset_id": _TEXT, "sha256": _TEXT},
    "blocks": {"block_id": _TEXT},
    "caption_links": {"caption_id": _TEXT},
    "coverage": {"feature": _TEXT, "source": _NUMBER, "extracted": _NUMBER, "diagnosed": _NUMBER, "silent": _NUMBER},
    "diagnostics": {"code": _TEXT, "severity": _TEXT, "message": _TEXT},
    "evidence": {"evidence_id": _TEXT},
    "nodes": {"node_id": _TEXT, "kind": _TEXT, "part_name": _TEXT, "xml_path": _TEXT, "sequence": _NUMBER},
    "parts": {"part_name": _TEXT},
    "relationships": {"relationship_id": _TEXT, "type": _TEXT},
    "sections": {"section_id": _TEXT, "level": _NUMBER},
}
DOCUMENT = {"doc_id": _TEXT, "filename": _TEXT, "sha256": _TEXT}


def misshapen(artifact) -> list[str]:
    """What keeps a JSON value from being an artifact."""
    if not isinstance(artifact, dict):
        return ["it is not an object"]
    out = [f"{name} is missing" for name in (*SHAPE, "document", "inventory", "schema_version", "extractor_version") if name not in artifact]

    def wrong(at: str, row, fields: dict) -> list[str]:
        if not isinstance(row, dict):
            return [f"{at} is not an object"]
        return [f"{at}.{k} is not {kinds[0].__name__}" for k, kinds in fields.items() if type(row.get(k)) not in kinds]

    for name, fields in SHAPE.items():
        rows = artifact.get(name)
        if rows is not None and not isinstance(rows, list):
            out.append(f"{name} is not a list")
        out += [x for k, row in enumerate(rows if isinstance(rows, list) else ()) for x in wrong(f"{name}[{k}]", row, fields)]
    out += wrong("document", artifact.get("document"), DOCUMENT) if "document" in artifact else []
    if "schema_version" in artifact and artifact["schema_version"] != SCHEMA_VERSION:
        out.append(f"schema_version is not {SCHEMA_VERSION}")
    return out or _unlinked(artifact)


def _unlinked(artifact: dict) -> list[str]:
    """What an artifact of the right shape says of nodes that are not there, or are twice or out of order."""
    nodes, blocks = artifact["nodes"] or [], artifact["blocks"] or []
    known, order = {n["node_id"] for n in nodes}, [n["sequence"] for n in nodes]
    rules = (
        ("nodes share an id", len(known) < len(nodes)),
        ("nodes are not in the order of their sequence", any(a >= b for a, b in zip(order, order[1:], strict=False))),
        ("a parent is no node", not {n.get("parent_id") for n in nodes} <= known | {None}),
        ("a block is made of what is no node", not {s for b in blocks for s in b.get("sources") or ()} <= known),
    )
    return [why for why, broken in rules if broken]


def canonical_json(artifact: dict) -> str:
    return ids.canonical(artifact)


def failed(artifact: dict) -> bool:
    """Whether something was lost in silence or an error was diagnosed."""
    return any(c["silent"] for c in artifact["coverage"] or []) or any(d["severity"] == "error" for d in artifact["diagnostics"])


def write_corpus(documents: DataFrame, folder: str) -> dict:
    """Every list of documents as a Parquet table below folder, content-addressed assets once each, artifacts as JSON lines, and the manifest as a table with a row for each document; the corpus's id and the manifest's folder.

    Packages are parsed once: what was read of them is written first and read back for everything else.
    """
    spark = documents.sparkSession
    documents = written(documents)
    for name in packages.LISTS:
        rows = packages.table(documents, name)
        (rows.drop("data") if name == "assets" else rows).write.mode("overwrite").parquet(f"{folder}/{name}")
    assets = packages.table(documents, "assets").groupBy("asset_id").agg(F.first("extension").alias("extension"), F.first("data").alias("data"))
    assets.write.mode("overwrite").parquet(f"{folder}/asset_data")
    artifacts(documents).write.mode("overwrite").json(f"{folder}/artifacts")
    views.health(documents).write.mode("overwrite").parquet(f"{folder}/health")
    corpus = f"corpus-{uuid.uuid4().hex}"
    states = spark.read.parquet(f"{folder}/health").where("state != 'failed'")
    manifest = states.select(F.lit(corpus).alias("corpus_id"), "doc_id", "filename", F.concat(F.lit(f"{folder}/artifacts#"), "doc").alias("artifact_uri"), F.col("state").alias("health"))
    manifest.write.mode("overwrite").json(f"{folder}/manifest")
    return {"corpus_id": corpus, "manifest": f"{folder}/manifest"}


def classify(assets: DataFrame, classifier, cache: DataFrame | None = None) -> DataFrame:
    """Classifications of assets (asset_id, sha256, mime_type, data) by a caller's classifier, which runs where the assets are; what cache holds is not asked again.

    classifier: classifier_version, prompt_version and classify(asset: dict) -> dict without the ids and versions.
    """
    import pyarrow as pa

    versions = (classifier.classifier_version, classifier.prompt_version)
    key = F.concat(F.lit("image-classification-"), F.sha2(F.concat("sha256", *[F.decode(F.unhex(F.lit(h)), "utf-8") for h in ("00" + versions[0].encode().hex(), "00" + versions[1].encode().hex())]), 256))
    rows = assets.dropDuplicates(["asset_id"]).withColumn("cache_key", key)
    schema = "asset_id string, asset_sha256 string, cache_key string, classifier_version string, prompt_version string, relevance string, decorative boolean, description string, likely_caption string, confidence double, error string"
    asked = rows if cache is None else rows.join(cache.select("cache_key"), "cache_key", "left_anti")

    def run(batches):
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            out = []
            for a in batch.to_pylist():
                fixed = {"asset_id": a["asset_id"], "asset_sha256": a["sha256"], "classifier_version": versions[0], "prompt_version": versions[1]}
                try:
                    said = contracts.CLASSIFICATION({**classifier.classify(a), **fixed})
                except Exception as e:  # a classifier's failure is a result of its own
                    said = contracts.CLASSIFICATION({**fixed, "relevance": "unknown", "decorative": False, "error": str(e) or type(e).__name__})
                out.append({**said, "cache_key": a["cache_key"]})
            kinds = [pa.bool_() if n == "decorative" else pa.float64() if n == "confidence" else pa.string() for n in names]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], k) for n, k in zip(names, kinds, strict=True)], names=names)

    fresh = asked.select("asset_id", "sha256", "mime_type", "data", "cache_key").mapInArrow(run, schema)
    return fresh if cache is None else fresh.unionByName(cache.join(rows.select("cache_key"), "cache_key", "left_semi").select(fresh.columns))
