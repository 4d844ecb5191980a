import hashlib

import regex
from test_bpe import REAL
from test_partenum import brute as similar
from test_winnow import brute as contaminated

import corpus_pipeline


def test_run_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = {d: t for d, t in docs.items() if t is not None and regex.search(r"\p{L}", t)}
    newest = {}
    for d, t in left.items():
        newest[t] = max(d, newest.get(t, d))
    left = {d: t for t, d in newest.items()}
    left = {d: left[d] for d, n, c in similar(list(left.items())) if n == 0 or c == d}
    dirty = {r[0] for r in contaminated(list(left.items()), items) if r[5]}
    left = {d: t for d, t in left.items() if d not in dirty}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert 0 < len(left) < len(docs) and got.keys() == left.keys()
    for d, t in left.items():
        ids = REAL.encode_ordinary(t)
        assert got[d].token_ids == ids and got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_keep_the_columns_of_documents_and_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int"
    rows = [(1, "the cat sat on the mat and more", "en", "s", 5, 0), (2, None, "en", None, None, 1), (3, "", None, "s", 0, 2), (4, "1234", "en", "s", 4, 3), (None, "le chat et le chien", "fr", "s", 9, 4), (5, "le chat et le chien", "fr", "s", 9, 5), (1, "the cat sat on the mat and more", "en", "s", 5, 0)]
    for data in (rows, rows[:0]):
        docs = spark.createDataFrame(data, schema)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
                docs = out
        assert sorted(r.doc_id for r in out.collect()) == ([1, 5] if data else [])


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "byte_bpe"]
