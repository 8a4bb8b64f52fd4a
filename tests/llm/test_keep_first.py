"""One row of each component stays, whatever ids the rows share."""

import random

import pytest
from docledger.llm import simhash, similar


def text(rng, n=60):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


@pytest.mark.parametrize("keep", [simhash.keep_one, similar.keep_one])
def test_texts_that_share_an_id_are_not_lost(spark, keep):
    rng = random.Random(2)
    a, b, c, d = (text(rng) for _ in range(4))
    docs = spark.createDataFrame([(1, a), (2, b), (2, a), (3, c), (3, d)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in keep(docs).collect()) == sorted([(1, a), (2, b), (3, c), (3, d)])


@pytest.mark.parametrize("keep", [simhash.keep_one, similar.keep_one])
def test_random_rows_that_share_ids(spark, keep):
    rng = random.Random(5)
    texts = [text(rng) for _ in range(15)] + [None, ""]
    rows = [(rng.choice([None, *range(12)]), rng.choice(texts)) for _ in range(80)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, t string, __h int")
    first = {}
    for d, t in rows:  # null and empty texts are alike
        k = t or ""
        first[k] = min(first.get(k, (True, 0)), (d is None, d or 0))
    got = [((r.text or ""), (r.doc_id is None, r.doc_id or 0)) for r in keep(docs).collect()]
    assert sorted(got) == sorted(first.items()) and keep(docs).columns == docs.columns
    assert sorted(got) == sorted(((r.text or ""), (r.doc_id is None, r.doc_id or 0)) for r in keep(docs).collect())
