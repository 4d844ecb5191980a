import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import bpe
from corpusmill.llm.catalog import op4_byte_bpe

RANKS = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
REAL = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = bpe.ByteBpe(RANKS, P.PATTERN)


def sha(b):
    return hashlib.sha256(b).hexdigest()


def check(texts):
    for t, (said, n, decoded) in zip(texts, OURS.encode(texts), strict=True):
        want = REAL.encode_ordinary(t)
        assert said == " ".join(map(str, want)), t[:80]
        assert n == len(want)
        assert decoded == t.encode()


EDGES = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b\n\nc", "\n", "\t x\r\ny ", "don't we'll I'm", "x y   z", "naïve Ünïcödé 東京 مرحبا", "😀😀 👩‍👩‍👧", "a\x1cb \x1f c",
         "1234567890" * 80, "aaaa" * 700, "-" * 999, "ab" * 400 + "東" * 300, "<|endoftext|>", "\x00\x01", "é" * 200]


def test_edges():
    check(EDGES)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\tab'sE1.é東"), st.characters(codec="utf-8")), max_size=60), max_size=5))
def test_random_texts(texts):
    check(texts)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeht", min_size=200, max_size=600))
def test_heap_and_matrix_agree(piece):
    raw = piece.encode()
    want = REAL._core_bpe.encode_single_piece(raw)
    assert OURS._by_heap(raw).tolist() == want
    assert OURS._by_matrix([raw], len(raw))[0].tolist() == want


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    texts = [f"w{i} x{i + 1} y" for i in range(300)]
    check(texts)


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    got = op4_byte_bpe(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    for r in got:
        ids = REAL.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(docs[r.doc_id].encode())


def test_rows(spark):
    schema = "doc_id long, text string, n_tokens string, _c0 int"
    df = spark.createDataFrame([(1, "a b", "x", 5), (1, "a b", "x", 5), (None, None, None, None), (2, "", "y", 6)], schema)
    out = bpe.encode_decode(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert out.columns == ["doc_id", "text", "_c0", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = sorted(((r.doc_id or 0, r._c0, r.token_ids, r.n_tokens) for r in out.collect()), key=repr)
    want = REAL.encode_ordinary("a b")
    assert rows == sorted([(1, 5, want, 2), (1, 5, want, 2), (0, None, [], 0), (2, 6, [], 0)], key=repr)
    assert bpe.encode_decode(df.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


@pytest.mark.parametrize("text", ["a b\nc", "x\ny z"])
def test_chunks_join_to_the_text(text):
    assert "".join(bpe.chunked(text)) == text


def test_chunks_met_again_and_again_stay_known(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe, "REMEMBERED", 400)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    one = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    texts = [f"the old house {'x' * (i % 300)} w{i}" for i in range(1280)] + ["", "y" * 700 + " the\n\n end "]
    learned = []
    learn = one.learn
    monkeypatch.setattr(one, "learn", lambda chunks: learned.extend(chunks) or learn(chunks))
    got = list(one.encode(texts))
    assert learned.count(" house") == 1  # with all forgotten at once: several times
    assert len(one.known) + len(one.older) <= 400
    for text, (said, n, decoded) in zip(texts, got):
        want = [x for piece in one.split(text) for x in one.merge([piece.encode()])[0]]
        assert (said, n, decoded) == (" ".join(map(str, want)), len(want), text.encode())
