import corpus_pipeline
import public_tokenizers
from docledger.llm import pii, toxicity
from tests.llm.test_decontaminate_plain import contaminated
from tokenizers import Tokenizer

def first_of_each(rows):
    """The smallest id of each group that a Jaccard similarity of 0.8 or more joins, over sets of 5 words, pair by pair."""
    sets = {}
    for d, t in rows.items():
        w = (t or "").lower().split()
        sets[d] = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    of = {d: d for d in rows}
    for a in sorted(rows):
        for b in sorted(rows):
            if a < b and of[a] != of[b] and (len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])):
                old, new = max(of[a], of[b]), min(of[a], of[b])
                of = {d: new if c == old else c for d, c in of.items()}
    return set(of.values())


def test_stages_equal_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    scorer = toxicity.Scorer(toxicity.fit(docs, labels))
    rows = {d: t for d, t in rows.items() if scorer.score(t) < 0.7}
    rows = {d: rows[d] for d in first_of_each(rows)}
    rows = {d: t for d, t in rows.items() if not contaminated(t, items)}
    rows = {d: pii.redacted(t, pii.spans(t)) for d, t in rows.items()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in rows.items()}


def test_stages_keep_the_columns_and_bear_odd_rows(spark, sf_dir):
    docs = spark.createDataFrame([(1, "a b c", "en", None, 5), (None, None, None, None, None), (2, "", "", "", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, sf_dir)
            assert frame.dtypes == docs.dtypes
        assert corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).count() in (0, 2, 3)
