"""Identities: SHA-256 over length-prefixed components, as Spark columns, as Python, and as DuckDB SQL."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Defaults of an extraction, as canonical JSON; they are part of every block's identity.
CONFIG = {
    "anchor_reading_order": "xml",
    "extract_linked_media": False,
    "include_comments": True,
    "include_headers_footers": True,
    "include_notes": True,
    "include_other_linked_parts": False,
    "normalizer_version": "1.0.0",
    "part_order": ["body", "headers", "footers", "footnotes", "endnotes", "comments", "other"],
}


_JSON = json.JSONEncoder(ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def canonical(value) -> str:
    """Compact JSON with sorted keys and without NaN."""
    return _JSON.encode(value)


CONFIG_JSON = canonical(CONFIG)


# Python


def _framed(component: str) -> bytes:
    data = component.encode()
    return len(data).to_bytes(8, "big") + data


def digest_py(*components) -> str:
    return hashlib.sha256(b"".join(_framed(canonical(c) if isinstance(c, (dict, list, tuple)) else str(c)) for c in components)).hexdigest()


def doc_id_py(data: bytes, length: int = 16) -> str:
    if not 1 <= length <= 64:
        raise ValueError("the length of a document id lies between 1 and 64")
    return "doc-" + hashlib.sha256(data).hexdigest()[:length]


def node_id_py(doc_id: str, part: str, path: str, kind: str) -> str:
    return "node-" + digest_py(doc_id, part, path, kind)[:24]


def node_ids_py(doc_id: str, part: str):
    """node_id_py of the nodes of one part, by path and kind: what they share is hashed once."""
    shared = hashlib.sha256(_framed(doc_id) + _framed(part))

    def made(path: str, kind: str) -> str:
        total = shared.copy()
        total.update(_framed(path) + _framed(kind))
        return "node-" + total.hexdigest()[:24]

    return made


def asset_id_py(data: bytes) -> str:
    return "asset-" + hashlib.sha256(data).hexdigest()


def view_id_py(name: str, version: str, config: dict | None, sources) -> str:
    return "view-" + digest_py(name, version, config or {}, list(sources))[:24]


def pipeline_id_py(kind: str, *components) -> str:
    return f"{kind}-{digest_py(*components)[:24]}"


# Spark columns


def _part(c: Column) -> Column:
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(c)), 16, "0")), F.encode(c, "utf-8"))


def _column(c) -> Column:
    return F.lit(c) if isinstance(c, str) else c


def digest(*components) -> Column:
    """Hex digest of columns or literal strings."""
    return F.sha2(F.concat(*[_part(_column(c)) for c in components]), 256)


def json_list(ids: Column) -> Column:
    return F.concat(F.lit('["'), F.array_join(ids, '","'), F.lit('"]')) if ids is not None else F.lit("[]")


def doc_id(data: Column, length: int = 16) -> Column:
    return F.concat(F.lit("doc-"), F.substring(F.sha2(data, 256), 1, length))


def node_id(doc: Column, part, path, kind) -> Column:
    return F.concat(F.lit("node-"), F.substring(digest(doc, part, path, kind), 1, 24))


def asset_id(data: Column) -> Column:
    return F.concat(F.lit("asset-"), F.sha2(data, 256))


def view_id(name: str, version: str, config: str | Column, sources: Column) -> Column:
    """sources: an array of node ids."""
    return F.concat(F.lit("view-"), F.substring(digest(name, version, config, json_list(sources)), 1, 24))


def evidence_id(doc: Column, kind, block: Column, derivation: str, sources: Column) -> Column:
    return F.concat(F.lit("evidence-"), F.substring(digest(doc, "1.0.0", kind, block, derivation, json_list(sources)), 1, 24))


# DuckDB SQL of the same


def sql_digest(*components: str) -> str:
    """components: SQL expressions."""
    return "sha256(" + " || ".join(f"(unhex(lpad(printf('%x', octet_length(encode({c}))), 16, '0')) || encode({c}))" for c in components) + ")"


def sql_node_id(doc: str, path: str, kind: str, part: str = "'word/document.xml'") -> str:
    return f"'node-' || substr({sql_digest(doc, part, path, kind)}, 1, 24)"


def sql_view_id(name: str, config: str, sources: str, version: str = "1.0.0") -> str:
    """sources: SQL of a JSON list."""
    return f"'view-' || substr({sql_digest(f"'{name}'", f"'{version}'", f"'{config}'", sources)}, 1, 24)"
