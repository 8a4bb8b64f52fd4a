import hashlib
import random
import re
from collections import Counter

import duckdb
from docledger.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        size = min(8, len(w))
        for p in range(len(w) - size + 1) if w and i is not None else ():
            windows.setdefault(tuple(w[p : p + size]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size in range(1, 9):
            for p in range(len(w) - size + 1):
                if (at := windows.get(tuple(w[p : p + size]))) is not None:
                    hit |= set(range(p, p + size))
                    found |= at
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2))
    return Counter(out)


def test_random_texts(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = ["A", "b", "é", "x9", "\U0001f600", "Zz", "K"]
    text = lambda n: rng.choice([" ", "\n", "--"]).join(rng.choice(vocabulary[: rng.randrange(2, 8)]) for _ in range(n))
    items = [(k, text(rng.choice([0, 1, 2, 3, 5, 7, 8, 9, 15]) if k > 5 else 8 + k)) for k in range(25)] + [(30, None), (None, "b b b")]
    docs = [(k, text(rng.randrange(60)) + " " + rng.choice(items)[1:][0].__str__() + " " + text(9)) for k in range(150)]
    docs += [(3, None), (4, ""), (None, docs[0][1]), docs[1], docs[1]]
    d = spark.createDataFrame([(a, b, 0, "x") for a, b in docs], "doc_id long, text string, n int, pos string")
    b = spark.createDataFrame([(a, b, 0) for a, b in items], "item_id long, text string, whole int")
    want = plain(docs, items)
    for limit in (64 << 20, -1):
        monkeypatch.setattr(decontaminate, "BROADCAST", limit)
        assert Counter(tuple(r) for r in decontaminate.digest(d, b).collect()) == want
    kept = decontaminate.keep_clean(d, b)
    assert kept.columns == d.columns
    assert kept.count() == sum(n for r, n in want.items() if not r[-1])


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontaminate.digest(d, b).collect()] == [(1, 3, 3, 1)]
    assert [tuple(r)[:4] for r in decontaminate.digest(d, b.limit(0)).collect()] == [(1, 3, 0, 0)]
    assert decontaminate.digest(d.limit(0), b).count() == 0


def test_tables_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = decontaminate.digest(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))
    cursor = con.sql(decontaminate.ORACLE)
    assert cursor.columns == got.columns
    assert Counter(cursor.fetchall()) == Counter(tuple(r) for r in got.collect())


def test_native_plan_without_document_shuffles(spark, sf_dir):
    got = decontaminate.digest(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "BroadcastHashJoin" in plan
