import random

import public_tokenizers
import pytest
from docledger.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = ["a", "th", "'", "'s", "'ll", "'re", "\xe9", "e\u0301", "\xdf", "\u03a3", "\u0130", "9", "\xbd", "!", "\u2026", "\u4e2d\u6587", "\U0001f600", "\u200d", "<|endoftext|>", "<|endof", "-", "The", "ing", "\x1c", "\u0301"]
SPACES = [" ", "\n", "\xa0", "\u2003", "\x85", "\t\t", "\u3000"]


def plain(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ids(blob):
    return [int.from_bytes(blob[k : k + 4], "little") for k in range(0, len(blob), 4)]


@pytest.mark.parametrize("leaf", [3, 7, 40])
def test_trees_equal_the_library(leaf):
    rng, codec = random.Random(leaf), bpe.Codec(PATH, True, leaf=leaf)
    for n in range(400):
        kinds = rng.sample(PIECES, rng.randrange(1, 8)) + ([rng.choice(SPACES)] if n % 3 == 0 else [])
        text = "".join(rng.choice(kinds) for _ in range(rng.randrange(120)))
        blob = codec.encode(text)
        assert ids(blob) == plain(text), text
        assert codec.decode(blob) == LIBRARY.decode(plain(text), skip_special_tokens=False)


def test_other_tokenizer_as_one_unsplit_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, rng, codec = Tokenizer.from_file(path), random.Random(1), bpe.Codec(path, False, leaf=24)
    for _ in range(300):
        text = "".join(rng.choice(PIECES + SPACES * 3) for _ in range(rng.randrange(150)))
        want = library.encode(text, add_special_tokens=False).ids
        blob = codec.encode(text)
        assert ids(blob) == want, text
        assert codec.decode(blob) == library.decode(want, skip_special_tokens=False)


def test_every_white_space_and_neighbour():
    codec = bpe.Codec(PATH, True)
    for c in [*range(0x3100), 0xFEFF, 0xE0020]:
        text = f"ab{chr(c)}cd"
        assert ids(codec.encode(text)) == plain(text), hex(c)


def test_very_long_run_without_white_space():
    rng = random.Random(3)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(200_000))
    assert ids(bpe.Codec(PATH, True).encode(text)) == plain(text)
    assert ids(bpe.Codec(PATH, True).encode("a" * 50_000)) == plain("a" * 50_000)
    assert ids(bpe.Codec(PATH, True).encode("'" * 30_000 + "s")) == plain("'" * 30_000 + "s")


def test_rows(spark, sf_dir):
    rows = [(1, "Hello  World", 5), (1, "Hello  World", 5), (None, None, 6), (4, "", 7), (5, "x" * 3000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted(((r.doc_id or 0, r.n_tokens, ids(bytes(r.ids)), r.decoded) for r in bpe.encode(docs, PATH).collect()), key=str)
    want = sorted(((d or 0, len(plain(t or "")), plain(t or ""), LIBRARY.decode(plain(t or ""), skip_special_tokens=False)) for d, t, _ in rows), key=str)
    assert got == want
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = bpe.encode(whole, PATH)
    assert {r.doc_id: ids(bytes(r.ids)) for r in got.collect()} == {r.doc_id: plain(r.text) for r in whole.collect()}
    assert {r.doc_id: r.decoded for r in bpe.decode(got, PATH).collect()} == {r.doc_id: r.decoded for r in got.collect()}


def test_a_text_of_many_leaves_is_joined_at_every_cut(monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(3, 12))) for _ in range(3000))
    codec, joins = bpe.Codec(PATH, True), []
    inner = codec._concatenated
    monkeypatch.setattr(codec, "_concatenated", lambda text, left, right: joins.append(left[1]) or inner(text, left, right))
    assert ids(codec.encode(text)) == plain(text)
    assert len(joins) == len(set(joins)) >= len(text) // bpe.LEAF and any(text[k - 1] != " " != text[k] for k in joins)
    # leaves alone are not the encoding
    cuts = [0, *sorted(joins), len(text)]
    assert [i for a, b in zip(cuts, cuts[1:], strict=False) for i in plain(text[a:b])] != plain(text)
    monkeypatch.setattr(codec, "_concatenated", lambda text, left, right: [left[0], right[1], left[2] + right[2]])
    assert ids(codec.encode(text)) != plain(text)
