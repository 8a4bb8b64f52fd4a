"""WARC derivatives: metadata and plain-text conversion records of HTML responses.

responses() makes response records of crawled pages; derive() makes of each response a metadata record (title, language,
links, status and header fields of the source) and a conversion record (plain text), both referring to it: they keep its
record id, target, date and payload digest. Record ids are made from what a record holds, so a run after a
lost executor makes the same ones. serialised() and parse() are the bytes of records and back, write() stores files.

Plain text: comments, scripts, styles and the head are left out; block elements begin a new line; character
references are resolved; white space within a line is one blank; empty lines are left out. A tag ends at the first >
outside quoted values; text after an unfinished tag or comment is dropped. All of it takes linear time.

Null html is an empty payload, a null url an empty target. Repeated pages give repeated records with equal ids; a null page id stays null.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.common import bounded, sliced

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
RECORD = "page_id {key}, kind string, record_id string, refers_to string, target_uri string, date string, content_type string, source_digest string, block_digest string, headers map<string,string>, block binary"

#: Elements that begin a line, elements whose text is not shown.
BLOCKS = frozenset(
    "address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
#: Elements whose text is taken as it stands, up to their own end tag, and those of them that a page may leave open.
HIDDEN, CODE = ("script", "style", "noscript", "template", "title"), ("script", "style")
IN_HEAD = frozenset((*HIDDEN, "head", "base", "link", "meta"))

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9-]*+)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in HIDDEN}
_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9-]*+)")
_ATTRIBUTE = re.compile(r"([A-Za-z:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


class Page:
    """What one pass over a page finds."""

    def __init__(self, text: str):
        self.title, self.lang, self.charset, self.links = "", "", "", []
        self._pieces: list[str] = []
        self._scan(text)
        lines = (" ".join(line.split()) for line in entities.unescape("".join(self._pieces)).split("\n"))
        self.text = "\n".join(line for line in lines if line)

    def _scan(self, text: str) -> None:
        at, n, head = 0, len(text), False
        absent: set[str] = set()  # end tags that do not come any more
        while at < n:
            i = text.find("<", at)
            if i < 0:
                self._pieces.append("" if head else text[at:].replace("\n", " "))
                return
            self._pieces.append("" if head else text[at:i].replace("\n", " "))
            if text.startswith("<!--", i):
                j = text.find("-->", i + 4)
                if j < 0:
                    return
                at = j + 3
                continue
            if text.startswith(("<!", "<?"), i):
                j = text.find(">", i)
                if j < 0:
                    return
                at = j + 1
                continue
            m = _TAG.match(text, i)
            if m:
                end, inside = m.end(), m[3]
            else:
                m = _NAME.match(text, i)
                if not m:
                    self._pieces.append("" if head else "<")
                    at = i + 1
                    continue
                end = text.find(">", i) + 1
                if not end:
                    return
                inside = text[m.end() : end - 1]
            closing, name = bool(m[1]), m[2].lower()
            at = end
            if not closing:
                self._open(name, inside)
                if name in HIDDEN and name not in absent:
                    end_tag = _END[name].search(text, end)
                    if not end_tag:
                        absent.add(name)
                        if name in CODE:
                            return
                    else:
                        if name == "title" and not self.title:
                            self.title = " ".join(entities.unescape(text[end : end_tag.start()]).split())
                        at = text.find(">", end_tag.end()) + 1 or n
            # the head goes on to its end, or to the first element that is none of a head's
            head = not closing and (name == "head" or (head and name in IN_HEAD)) or (closing and head and name != "head")
            if name in BLOCKS:
                self._pieces.append("\n")

    def _open(self, name: str, inside: str) -> None:
        if name in ("a", "html", "meta") and inside:
            values = {k.lower(): entities.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(inside)}
            if name == "a" and "href" in values:
                self.links.append(values["href"])
            elif name == "html":
                self.lang = self.lang or values.get("lang", "")
            elif name == "meta":
                self.charset = self.charset or values.get("charset", "")


def digest_of(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=5)}>"


def response(page_id, url: str | None, html: str | None, date: str = DATE) -> dict:
    payload = (html or "").encode()
    head = {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}
    block = ("HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + payload
    source = digest_of(payload)
    return {
        "page_id": page_id, "kind": "response", "record_id": record_id("response", str(page_id), url or "", date, source), "refers_to": None, "target_uri": url or "", "date": date,
        "content_type": "application/http; msgtype=response", "source_digest": source, "block_digest": digest_of(block), "headers": head, "block": block,
    }


def split_response(block: bytes) -> tuple[str, dict, bytes]:
    """Status line, header fields and payload of an HTTP response."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        head, payload = b"", block
    lines = head.decode("utf-8", "replace").split("\r\n")
    return lines[0], {k.strip(): v.strip() for k, c, v in (line.partition(":") for line in lines[1:]) if c}, payload


def derived(source: dict) -> list[dict]:
    """The metadata and the conversion record of a response."""
    status, head, payload = split_response(source["block"])
    page = Page(payload.decode("utf-8", "replace"))
    fields = [("status", status), ("title", page.title), ("language", page.lang), ("charset", page.charset)] + [(f"source-{k.lower()}", v) for k, v in sorted(head.items())]
    fields += [("outlinks", str(len(page.links)))] + [("outlink", link) for link in page.links]
    out = []
    for kind, content, block in (
        ("metadata", "application/warc-fields", "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode("utf-8", "replace")),
        ("conversion", "text/plain; charset=utf-8", page.text.encode("utf-8", "replace")),
    ):
        out.append({
            "page_id": source["page_id"], "kind": kind, "record_id": record_id(kind, source["record_id"]), "refers_to": source["record_id"], "target_uri": source["target_uri"], "date": source["date"],
            "content_type": content, "source_digest": source["source_digest"], "block_digest": digest_of(block), "headers": head, "block": block,
        })
    return out


def _records(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{**r, "headers": list(r["headers"].items())} for r in rows], schema=schema)


def _schema(kind: pa.DataType) -> pa.Schema:
    text = pa.string()
    names = ("kind", "record_id", "refers_to", "target_uri", "date", "content_type", "source_digest", "block_digest")
    return pa.schema([("page_id", kind), *((n, text) for n in names), ("headers", pa.map_(text, text)), ("block", pa.binary())])


def responses(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """A response record of each page (key, url, html)."""
    bounded(pages.sparkSession)

    def run(batches):
        for b in sliced(batches):
            ids, urls, texts = (b.column(k).to_pylist() for k in range(3))
            yield _records([response(*x) for x in zip(ids, urls, texts, strict=True)], _schema(b.column(0).type))

    return pages.select(F.col(key).alias("k"), F.col("url").alias("u"), F.col("html").alias("h")).mapInArrow(run, RECORD.format(key=pages.schema[key].dataType.simpleString()))


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the response records; other kinds have none."""
    bounded(records.sparkSession)

    def run(batches):
        for b in sliced(batches):
            rows = [{**r, "headers": dict(r["headers"] or ())} for r in b.to_pylist()]
            yield _records([d for r in rows for d in derived(r)], _schema(b.column(0).type))

    names = [x.split()[0] for x in RECORD.split(", ")]
    return records.where("kind = 'response'").select(*names).mapInArrow(run, RECORD.format(key=records.schema["page_id"].dataType.simpleString()))


def serialised(r: dict) -> bytes:
    """The bytes of a record."""
    fields = [
        ("WARC-Type", r["kind"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["date"]), ("WARC-Target-URI", r["target_uri"]), ("Content-Type", r["content_type"]),
        ("WARC-Block-Digest", r["block_digest"]), ("WARC-Payload-Digest" if r["kind"] == "response" else "X-Source-Payload-Digest", r["source_digest"]),
    ]
    if r["refers_to"]:
        fields += [("WARC-Refers-To", r["refers_to"]), ("WARC-Refers-To-Target-URI", r["target_uri"]), ("WARC-Refers-To-Date", r["date"])]
        fields += [(f"X-Source-{k}", v) for k, v in sorted(dict(r["headers"]).items())]
    head = "".join(f"{k}: {' '.join((v or '').split())}\r\n" for k, v in [*fields, ("Content-Length", str(len(r["block"])))])
    return f"{VERSION}\r\n{head}\r\n".encode() + bytes(r["block"]) + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of each record in data."""
    at = 0
    while at < len(data):
        gap = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:gap].decode().split("\r\n")
        if first != VERSION:
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        stop = gap + 4 + int(fields["Content-Length"])
        yield fields, data[gap + 4 : stop]
        at = stop + 4


def members(records: DataFrame) -> DataFrame:
    """member: each record's bytes as a gzip member of its own, which ends with a zero byte."""

    def packed(data: bytes) -> bytes:
        # a member ends with the length of what it holds; beyond 16 MiB an empty member, which ends with zeros, follows
        return gzip.compress(data, mtime=0) + (gzip.compress(b"", mtime=0) if len(data) >> 24 else b"")

    def run(batches):
        for b in sliced(batches):
            rows = [{**r, "headers": dict(r["headers"] or ())} for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([packed(serialised(r)) for r in rows], pa.binary())], names=["member"])

    return records.select(*[x.split()[0] for x in RECORD.split(", ")]).mapInArrow(run, "member binary")


def write(records: DataFrame, folder: str) -> None:
    """Files of records in folder, a gzip member for each record, by Spark's own writer: lost tasks leave no parts of files."""
    spark = records.sparkSession
    # the zero byte at the end of each member is what the writer puts after a line
    lines = members(records).select(F.expr("cast(substring(member, 1, length(member) - 1) as string)").alias("value"))
    lines.write.option("lineSep", "\0").text(folder)
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.listStatus(top):
        name = found.getPath().getName()
        if name.startswith("part-"):
            fs.rename(found.getPath(), spark._jvm.org.apache.hadoop.fs.Path(top, name.removesuffix(".txt") + ".warc.gz"))


def digest(pages: DataFrame) -> DataFrame:
    """The derived records of every page, their blocks by digest and length."""
    out = derive(responses(pages))
    source = F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries("headers")))), 256)
    return out.select(
        "page_id", "kind", "record_id", "refers_to", "target_uri", "date", "content_type", "source_digest", "block_digest", F.octet_length("block").cast("long").alias("n_bytes"), F.sha2("block", 256).alias("block_sha256"), source.alias("headers_sha256")
    )
