"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Kinds and their base rules (spans are in code points, the end exclusive):

=========  ===============================================================================
email      local part, @, at least two dotted labels
ip         four dotted numbers of at most 255
card       16 to 19 digits, single spaces or hyphens between them, passing Luhn
phone      + and 8 to 15 digits with blanks, dots, hyphens and brackets between them
iban       country, check digits and 11 to 30 characters passing mod-97 and of the country's length
ssn        3-2-4 digits; kept only if nearby words raise its score
=========  ===============================================================================

The first four are *base* spans: leftmost, not overlapping per kind, kept whatever their score. A match that
fails its check is dropped and its text is not searched again. The last two are kept from MIN_SCORE on.
Null text has no spans. A row of the input is a row of the result, repeated rows included; null ids stay null.
All searches take time in proportion to the text, whatever it holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.llm.common import bounded


KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
MIN_SCORE = 0.5

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("score", T.DoubleType(), False),
    ]
)

#: Score of a confirmed span before its context is read.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.85, "phone": 0.7, "iban": 0.9, "ssn": 0.3}

#: Words whose nearness makes a kind likelier, and words that make any kind less likely.
CONTEXT = {
    "email": ("mail", "e-mail", "email", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "tarjeta", "carte", "karte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "taxpayer"),
}
DOUBT = ("example", "sample", "test", "dummy", "version", "isbn")


def _whole(words: tuple[str, ...]) -> re.Pattern:
    """Any of the words, not within another one."""
    return re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)")


_LIKELIER, _DOUBTFUL = {kind: _whole(words) for kind, words in CONTEXT.items()}, _whole(DOUBT)

#: Lengths of account numbers by country.
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21,
    "HU": 28, "IE": 22, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24,
}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits can only begin a match at its first digit: what follows the run decides for all of them.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_CUT_FIRST, _CUT_LAST = re.compile(r"^\w+"), re.compile(r"\w+$")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def mod97(number: str) -> bool:
    rest = 0
    for c in number[4:] + number[:4]:
        v = int(c, 36)
        rest = (rest * (10 if v < 10 else 100) + v) % 97
    return rest == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """All starts left of one @ share what follows it, so each @ is tried once, from the first possible start."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        number = m[0].replace(" ", "")
        size = IBAN_LENGTH.get(number[:2])
        if size and len(number) >= size and mod97(number[:size]):
            end, left = m.start(), size
            while left:
                left -= text[end] != " "
                end += 1
            if end == len(text) or not text[end].isalnum():
                yield m.start(), end


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns}


def score(kind: str, text: str, start: int, end: int, reach: int = 40) -> float:
    """The prior of the kind, moved by whole words that stand within reach, whatever their case."""
    lo, hi = max(0, start - reach), min(len(text), end + reach)
    # a word that is cut at the end of the reach is none
    before, after = text[lo:start], text[end:hi]
    before = _CUT_FIRST.sub("", before) if lo and text[lo - 1].isalnum() else before
    after = _CUT_LAST.sub("", after) if hi < len(text) and text[hi].isalnum() else after
    near, value = f"{before} {after}".lower(), PRIOR[kind]
    value += 0.25 * bool(_LIKELIER[kind].search(near)) - 0.2 * bool(_DOUBTFUL.search(near))
    return round(min(1.0, max(0.0, value)), 4)


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of one text, by kind as listed, then by start."""
    found = []
    for kind in KINDS if text else ():
        for start, end in FINDERS[kind](text):
            value = score(kind, text, start, end)
            if kind in BASE_KINDS or value >= MIN_SCORE:
                found.append((kind, start, end, value))
    return found


@F.udf(T.ArrayType(SPAN, False), useArrow=True)
def _spans(text):
    return spans(text)


def redacted(text: str | None, found: list) -> str | None:
    """Text with every span replaced by its kind; spans that overlap are replaced together, by the kind that begins first."""
    if not text or not found:
        return text
    parts, done = [], 0
    reach, kind = -1, None
    begin = 0
    for k, s, e in sorted(((x[0], x[1], x[2]) for x in found), key=lambda x: (x[1], -x[2])) + [("", len(text) + 1, len(text) + 1)]:
        if s < reach:
            reach = max(reach, e)
            continue
        if kind is not None:
            parts += [text[done:begin], f"[{kind.upper()}]"]
            done = reach
        kind, begin, reach = k, s, e
    return "".join(parts) + text[done:]


@F.udf(T.StringType(), useArrow=True)
def _redacted(text, found):
    return redacted(text, found)


def find(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """docs with a column of spans (kind, start, end, score). A column of that name is replaced."""
    bounded(docs.sparkSession)
    return docs.withColumn(into, _spans(F.col(text)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs, same columns, with every span of the text replaced by its kind in brackets."""
    bounded(docs.sparkSession)
    return docs.withColumn(text, _redacted(F.col(text), _spans(F.col(text))))


def joined(found: Column) -> Column:
    """kind:start:end of the spans, comma-joined in their order."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, SHA-256 of the base spans, and all spans as text."""
    found = find(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [_count(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
