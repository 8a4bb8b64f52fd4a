import re

import pytest
from docledger.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TEXTS = [
    "", "a@b.c_d@e.f", "@@x@y.z@q.r", "a@b a@b.c.", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0003.4", "..1.2.3", "999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "é +1 (743) 555-3824 + 12 +1234567 +12345678", "+1-2-3-4-5-6-7-8-", "12--34 5", "4111111111111111" * 3,
    "mail me: x.y@mail.example.com\x00 or ünï@côde.fr", "1" * 50 + ".1.1.1", "+" * 20 + "1 23",
]


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_equal_plain_regular_expressions(text):
    assert [s[:3] for s in pii.spans(text) if s[0] in pii.BASE_KINDS] == plain(text)


def test_random_texts():
    import random

    rng = random.Random(7)
    for _ in range(3000):
        text = "".join(rng.choice("a1@.+- (9é2%") for _ in range(rng.randrange(60)))
        assert [s[:3] for s in pii.spans(text) if s[0] in pii.BASE_KINDS] == plain(text)


def test_checksums_and_context():
    assert [s[0] for s in pii.spans("GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, GB83 WEST 1234 5698 7654 32")] == ["iban", "iban"]
    assert not pii.spans("part 123-45-6789") and [s[0] for s in pii.spans("her SSN 123-45-6789")] == ["ssn"]
    near, far = pii.spans("call +1 555 123 4567")[0][3], pii.spans("xx +1 555 123 4567")[0][3]
    assert near > far


def test_long_hostile_texts_take_linear_time():
    for piece in ("a", "1", "1.", "@a", "+1", "AB12 ", "1-"):
        pii.spans(piece * (1_000_000 // len(piece)))


def test_redaction():
    text = "x a@b.cd y +1 555 123 4567."
    assert pii.redacted(text, pii.spans(text)) == "x [EMAIL] y [PHONE]."
    assert pii.redacted("abcdef", [("ip", 1, 3, 1.0), ("card", 2, 5, 1.0)]) == "a[IP]f"
    assert pii.redacted(None, None) is None


def test_edge_rows(spark):
    rows = [(1, "a@b.cd", "x"), (1, "a@b.cd", "x"), (None, None, None), (3, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {(r.doc_id, r.n_email, r.spans) for r in pii.digest(docs).collect()}
    assert got == {(1, 1, "email:0:6"), (None, 0, ""), (3, 0, "")} and pii.digest(docs).count() == 4
    assert pii.digest(docs.limit(0)).count() == 0
    assert pii.redact(docs).columns == docs.columns
