import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from corpusmill.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def byte_level():
    """The published byte-to-character table, from its own rule."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {}, 0
    for b in range(256):
        if b in own:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


class Slow:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.chars = byte_level()

    def tokens(self, text):
        enc = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.chars[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])

    def groups(self, text):
        if not text:
            return []
        a, b = self.tokens(text)
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        ends = sorted({s[2] for s in spans[0]} & {s[2] for s in spans[1]})
        out, low = [], 0
        for high in ends:
            out.append(tuple([i for i, x, y in side if low <= x and y <= high] for side in spans))
            low = high
        return out


SLOW = Slow()


def brute(rows):
    cut = [SLOW.groups(t) for _, t in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in cut]
    counts = Counter(p for pairs in links for p in set(pairs))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for (i, _), g, pairs in zip(rows, cut, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        sha = hashlib.sha256(said.encode()).hexdigest() if g else ""
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(pairs), sum(counts[p] == top[p[0]] for p in pairs), sum(counts[p] for p in pairs), sha, said))
    return sorted(out, key=repr)


def run(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in ta.align(df, A, B, said=True).collect()), key=repr)


ODD = [
    None, "", " ", "  two  spaces ", "\n\n a\tb \r\n", "<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b ▁c", "plain words ▁", "日本語のテキスト", "🙂🙂 🙂‍🙂", "don't we'll it's", "x\x1cy z\x85w   q", "　wide　 space",
    "=" * 700, "ab" * 900, " " * 333, "\x00 nul \x01", "é ﬁ ½ Ａ", "é" * 50 + " " + "﻿", "1234567890 " * 20, "word\nnext line. Other \nx",
]


def test_odd_texts(spark):
    rows = list(enumerate(ODD)) + [(None, "a null id"), (3, ODD[3]), (3, ODD[3])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    assert run(spark, rows) == brute(rows)


def test_buckets_memory_and_large_groups_change_nothing(spark, monkeypatch):
    rng = random.Random(1)
    words = ["der", "Die", "straße", "naïve", "日本", "x1", "...", "\n", "  ", "http://a.b/c?d=1"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(80)] + list(enumerate(ODD))
    want = brute(rows)
    for name, value in (("BUCKET", 400), ("REMEMBERED", 20), ("JOINED", 30), ("SQUARE", 2)):
        monkeypatch.setattr(ta, name, value)
    assert run(spark, rows, parts=3) == want


def test_pieces_of_several_buckets_stay():
    with open(A, "rb") as f, open(B, "rb") as g:
        aligner = ta.Aligner(f.read(), g.read())
    ta.bucket(aligner, ["one two", "two three  four"], False)
    ta.bucket(aligner, ["two five a▁b"], False)
    before = ta.bucket(aligner, ["one two"], True)
    aligner.make_room()
    assert set(aligner.known) == {" one", " two"}
    after = ta.bucket(aligner, ["one two"], True)
    for name, value in before.items():
        assert (after[name] == value).all() if hasattr(value, "all") else after[name] == value
    aligner.make_room()
    assert ta.bucket(aligner, ["six two"], True)["said"] == [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in SLOW.groups("six two"))]


def test_cut_places_are_ends_of_both_sides():
    for text in [*filter(None, ODD), "one two  three\nfour five"]:
        pieces = ta.cut_text(" " + text)
        assert "".join(pieces) == " " + text
        got = [SLOW.tokens(p[1:]) for p in pieces if p != " "]
        if all(a for a, _ in got) and len(got) == len(pieces):
            whole = SLOW.tokens(text)
            assert [x for a, _ in got for x in a] == whole[0] and [x for _, b in got for x in b] == whole[1]


def test_extra_columns_are_not_looked_at(spark):
    df = spark.createDataFrame([(1, "a b", 5, "x")], SCHEMA + ", n_a int, pairs string")
    got = ta.align(df, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert tuple(got.first()) == brute([(1, "a b")])[0][:8]
