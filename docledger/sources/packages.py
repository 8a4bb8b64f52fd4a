"""Packages as tables: one task parses a group of files, everything after is DataFrame operators.

A file that is no package, or that fails in any other way, is a row with its error; the job goes on.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger import ids
from docledger.sources.docx import read_package


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_S, _L, _I, _B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()

#: Facts of a node's payload that operators read; the whole payload is JSON besides.
HOT = {
    "text": _S, "deleted": _B, "latex": _S, "style_id": _S, "style_name": _S, "outline_level": _I, "num_id": _S, "list_level": _I, "num_fmt": _S, "ordered": _B, "marker": _S, "row_index": _I,
    "column_index": _I, "column_span": _I, "is_header": _B, "grid_column_count": _I, "asset_id": _S, "instruction": _S,
}
NODE = _struct(
    node_id=_S, sequence=_L, parent_id=_S, sibling_index=_L, kind=_S, part_name=_S, xml_path=_S, relationship_id=_S, status=_S, ancestors=T.ArrayType(_L), subtree_end=_L, payload=_S, **HOT
)
ASSET = _struct(asset_id=_S, sha256=_S, mime_type=_S, original_name=_S, byte_size=_L, source_parts=T.ArrayType(_S), extension=_S, data=T.BinaryType())
OCCURRENCE = _struct(feature=_S, part_name=_S, xml_path=_S, value=_S, relationship_id=_S, target_part=_S)
DIAGNOSTIC = _struct(code=_S, severity=_S, message=_S, part_name=_S, xml_path=_S, relationship_id=_S, source_node_id=_S)
PART = _struct(part_name=_S, content_type=_S, relationship_count=_I)
RELATIONSHIP = _struct(source_part=_S, relationship_id=_S, type=_S, target=_S, mode=_S, target_part=_S, external_url=_S, error=_S)
LISTS = {"nodes": NODE, "assets": ASSET, "inventory": OCCURRENCE, "diagnostics": DIAGNOSTIC, "parts": PART, "relationships": RELATIONSHIP}
DOCUMENT = _struct(doc=_S, filename=_S, doc_id=_S, sha256=_S, error_type=_S, error=_S, **{k: T.ArrayType(v) for k, v in LISTS.items()})


def _facts(node: dict) -> dict:
    """The payload of a node, with the facts of its numbering beside the others."""
    payload = node["payload"]
    if node["kind"] != "paragraph":
        return payload
    numbering = payload.get("numbering") or {}
    form, ordered = numbering.get("num_fmt"), numbering.get("ordered")
    if ordered is None and form:
        ordered = form.lower() not in ("bullet", "none")
    return {**payload, "num_id": numbering.get("num_id"), "list_level": numbering.get("ilvl"), "num_fmt": form, "ordered": ordered, "marker": numbering.get("marker_template")}


def _document(doc: str, data: bytes, policy: dict) -> dict:
    name = doc.rsplit("/", 1)[-1]
    row = {"doc": doc, "filename": name, "error_type": None, "error": None}
    try:
        found = read_package(bytes(data), name, **policy)
    except Exception as e:  # one bad file is a row, not a failed job
        return {**row, "doc_id": None, "sha256": None, "error_type": type(e).__name__, "error": str(e)[:2000], **{k: [] for k in LISTS}}
    found["inventory"] = [{**r, "value": None if r["value"] is None else str(r["value"])} for r in found["inventory"]]
    return {**row, **found}


def _field(rows: list[dict], facts: list[dict] | None, name: str) -> list:
    """One field of the rows of a list; facts: of nodes."""
    if facts is None:
        return [r[name] for r in rows]
    if name == "payload":
        return [ids.canonical(r["payload"]) for r in rows]
    return [f.get(name) for f in facts] if name in HOT else [r[name] for r in rows]


def _batch(documents: list[dict], schema):
    """Documents as one Arrow batch, column by column."""
    import pyarrow as pa

    columns = []
    for field in schema:
        if field.name not in LISTS:
            columns.append(pa.array([d[field.name] for d in documents], field.type))
            continue
        rows = [r for d in documents for r in d[field.name]]
        facts = [_facts(n) for n in rows] if field.name == "nodes" else None
        kind = field.type.value_type
        inner = pa.StructArray.from_arrays([pa.array(_field(rows, facts, f.name), f.type) for f in kind], fields=list(kind))
        ends = [0, *accumulate(len(d[field.name]) for d in documents)]
        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner, type=field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


#: Files that become one batch: so many, or those up to so many bytes, of which the last may be larger.
TOGETHER, TOGETHER_BYTES = 64, 1 << 18


def parse(files: DataFrame, *, only: dict[str, list[str]] | None = None, **policy) -> DataFrame:
    """A row for each file (path, content): DOCUMENT. policy: headers, notes, comments (all read unless set False).

    Every file is read whole. only: the lists that are given of it, and the fields of each (all if there are none); for all lists, leave it out.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = DOCUMENT
    if only is not None:
        lists = {k: T.ArrayType(T.StructType([f for f in LISTS[k] if not fields or f.name in fields])) for k, fields in only.items()}
        shape = T.StructType([f for f in DOCUMENT if f.name not in LISTS] + [T.StructField(k, lists[k]) for k in LISTS if k in lists])
    schema = to_arrow_schema(shape)

    def run(batches):
        for batch in batches:
            documents, size = [], 0
            for k in range(batch.num_rows):
                data = batch.column(1)[k].as_py()
                documents.append(_document(batch.column(0)[k].as_py(), data, policy))
                size += len(data)
                if len(documents) == TOGETHER or size >= TOGETHER_BYTES:
                    yield _batch(documents, schema)
                    documents, size = [], 0
            if documents:
                yield _batch(documents, schema)

    return files.select("path", "content").mapInArrow(run, shape)


def read(spark: SparkSession, path: str, glob: str = "*.docx", **policy) -> DataFrame:
    """The packages below path."""
    return parse(spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path), **policy)


def table(documents: DataFrame, name: str) -> DataFrame:
    """Rows of one list of all documents, with doc and doc_id."""
    return documents.select("doc", "doc_id", F.explode(name).alias("_x")).select("doc", "doc_id", "_x.*")
