import random
import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import public_tokenizers
import pytest
from docledger.llm import token_counts as t
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def rows(df):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in df.collect()}


def test_batches_in_any_order_and_repeated(spark, tmp_path):
    rng = random.Random(3)
    state, batches = {}, []
    for n in range(6):
        change = []
        for _ in range(30):
            d = rng.randrange(40)
            if d not in state:
                state[d] = (rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]), rng.randrange(50))
                change.append((*state[d][:3], 1, state[d][3]))
            elif rng.random() < 0.4:
                change.append((*state[d][:3], -1, -state.pop(d)[3]))
            else:
                new = rng.randrange(50)
                change.append((*state[d][:3], 0, new - state[d][3]))
                state[d] = (*state[d][:3], new)
        batches.append((f"batch/{n}", spark.createDataFrame(change, t.CHANGE)))
    want = {}
    for s, lang, v, n in state.values():
        docs, tokens = want.get((s, lang, v), (0, 0))
        want[s, lang, v] = (docs + 1, tokens + n)
    rollup = t.Rollup(spark, str(tmp_path / "r"))
    assert rows(rollup.totals()) == {}
    order = [*batches, *batches[:3]]
    rng.shuffle(order)
    done = set()
    for name, change in order:
        assert rollup.commit(name, change) == (name not in done)
        done.add(name)
    assert rows(rollup.totals()) == want
    rollup.compact()
    assert rows(rollup.totals()) == want and len(rollup._read()) == 1
    assert not rollup.commit(*batches[0]) and t.Rollup(spark, str(tmp_path / "r")).committed("batch/5")
    assert rows(rollup.totals()) == want


def test_a_broken_commit_leaves_nothing(spark, tmp_path):
    rollup = t.Rollup(spark, str(tmp_path))
    bad = spark.range(1).selectExpr("'s' source", "'l' lang", "'v' version", "1L docs", "cast(raise_error('lost') as long) tokens")
    try:
        rollup.commit("x", bad)
        raise AssertionError
    except Exception as e:
        assert "lost" in str(e)
    good = spark.createDataFrame([("s", "l", "v", 1, 5)], t.CHANGE)
    assert not rollup.committed("x") and rollup.commit("x", good)
    assert rows(rollup.totals()) == {("s", "l", "v"): (1, 5)}


def test_racing_commits_and_compactions(spark, tmp_path):
    rollup, change = t.Rollup(spark, str(tmp_path)), spark.createDataFrame([("s", "l", "v", 1, 5)], t.CHANGE)
    with ThreadPoolExecutor(6) as pool:
        done = list(pool.map(lambda _: t.Rollup(spark, str(tmp_path)).commit("x", change), range(6)))
        assert sum(done) == 1 and rows(rollup.totals()) == {("s", "l", "v"): (1, 5)}
        work = [lambda k=k: t.Rollup(spark, str(tmp_path)).commit(f"b{k}", change) for k in range(4)] + [lambda: t.Rollup(spark, str(tmp_path)).compact() or True] * 3
        assert all(pool.map(lambda f: f(), work))
    assert rows(rollup.totals()) == {("s", "l", "v"): (5, 25)}
    rollup.compact()
    rollup.vacuum()
    assert rows(rollup.totals()) == {("s", "l", "v"): (5, 25)} and not rollup.commit("b2", change) and rollup.commit("new", change)
    assert rows(rollup.totals()) == {("s", "l", "v"): (6, 30)}


def test_a_compaction_that_is_cut_off_changes_nothing(spark, tmp_path, monkeypatch):
    rollup, change = t.Rollup(spark, str(tmp_path)), spark.createDataFrame([("s", "l", "v", 1, 5)], t.CHANGE)
    assert rollup.commit("a", change) and rollup.commit("b", change)

    def lost(*_):
        assert rows(rollup.totals()) == {("s", "l", "v"): (2, 10)}
        assert t.Rollup(spark, str(tmp_path)).commit("c", change)
        raise OSError

    with monkeypatch.context() as m:
        m.setattr(rollup, "_placed", lost)
        with pytest.raises(OSError):
            rollup.compact()
    assert rows(rollup.totals()) == {("s", "l", "v"): (3, 15)} and rollup.compact() and not rollup.compact()
    assert rows(rollup.totals()) == {("s", "l", "v"): (3, 15)}


def plain(found):
    """Totals of the documents that stay, by the library."""
    library, first = Tokenizer.from_file(PATH), {}
    for d, text, lang, source in sorted(found, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(text, (source, lang))
    out = Counter()
    for text, group in first.items():
        for version, n in ((t.WORDS, len(re.findall(r"[^\x09-\x0D\x20]+", text or ""))), (t.BPE, len(library.encode(text or "", add_special_tokens=False).ids))):
            out[(*group, version, "docs")] += 1
            out[(*group, version, "tokens")] += n
    return {(s, g, v): (n, out[s, g, v, "tokens"]) for (s, g, v, kind), n in out.items() if kind == "docs"}


def test_table_against_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert rows(t.digest(docs, PATH)) == plain(found)


def test_edge_rows(spark):
    found = [(1, "a b1", None, "s"), (2, "a b1", "en", "s"), (3, None, "en", "s"), (4, "", "en", "s"), (None, "a b1", "en", "s"), (None, "only", "en", "z"), (None, "only", "en", "z"), (5, "c", None, None)]
    docs = spark.createDataFrame([(*r, "x") for r in found], "doc_id long, text string, lang string, source string, version string")
    got = rows(t.digest(docs, PATH))
    assert got == plain(found) and got["s", None, t.WORDS] == (1, 2) and got["z", "en", t.BPE][0] == 1 and got[None, None, t.WORDS] == (1, 1)
    assert t.digest(docs.limit(0), PATH).count() == 0


def test_real_tokenizer(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    library = Tokenizer.from_file(path)
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in t.bpe_counts(docs, path).collect()} == want
