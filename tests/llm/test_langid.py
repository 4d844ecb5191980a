import zlib

from corpusmill.llm import langid
from corpusmill.llm.catalog import op7_language_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op7_language_id(spark, sf).collect()
    assert len(got) == len(truth)
    right = total = 0
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.held_out and truth[r.doc_id].lang is not None:
            total += 1
            right += r.lang_pred == truth[r.doc_id].lang
    assert total > 100 and right / total > 0.97


def test_prediction_uses_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs)
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs.selectExpr("doc_id", "text", "'xx' lang", "0 score"), model).collect()}
    assert a == b


def test_rows(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(1, "the cat and the dog", "en", "s"), (2, "le chat et le chien", "fr", "s"), (3, None, "en", None), (4, "", "fr", None), (5, "12 34 --", "en", None), (None, "the the the", None, None), (1, "the cat and the dog", "en", "s")]
    df = spark.createDataFrame(rows, schema)
    model = langid.train(df)
    out = langid.predict(df, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in out.collect()))
    assert got == [(0, "en"), (1, "en"), (1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und")]
    assert langid.keep_known(df, model).columns == df.columns
    assert langid.keep_known(df, model).count() == 4
    empty = langid.train(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, empty).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0


def test_long_text_is_read_whole(spark):
    import numpy as np

    a = np.frombuffer(("ab " * 200_000 + "zqx").encode(), np.uint8)
    b = np.frombuffer(("ab " * 200_000).encode(), np.uint8)
    assert langid.presence([a]).sum() > langid.presence([b]).sum()


def test_labels_of_long_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("lang is not null and text is not null")
    model = langid.train(docs.filter(~langid.held_out()))
    by_lang = {}
    for r in docs.filter(langid.held_out()).select("lang", "text").collect():
        by_lang.setdefault(r.lang, []).append(r.text)
    rows = [(lang, "\n".join(texts * (1 + 3_000_000 // sum(map(len, texts))))[:3_000_000]) for lang, texts in sorted(by_lang.items())]
    got = langid.predict(spark.createDataFrame(rows, "lang string, text string"), model).collect()
    assert len(got) >= 4 and all(r.lang_pred == r.lang for r in got)
    assert all(r.score > 0.6 for r in got), [(r.lang, r.score) for r in got]


def test_short_text_is_one_piece():
    import numpy as np

    text = np.frombuffer(b"a few words of a text " * 20, np.uint8)
    flags = langid.presence([text])[0]
    assert np.allclose(langid.vectors([text])[0], flags / np.sqrt(flags.sum()))
    assert not langid.vectors([np.zeros(0, np.uint8)]).any()
