import hashlib
import random

import pytest

from corpusmill.llm import suffix


def brute(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    count = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            w = hash(t[i : i + length])
            count[w] = count.get(w, 0) + 1
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[hash(t[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n, share):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(k)) for k in (40, 60, 90, 90)]
    rows = []
    for i in range(n):
        parts = [word() for _ in range(rng.randint(0, 200))]
        if rng.random() < share:
            parts.insert(rng.randint(0, len(parts)), passages[3])
        for p in passages[:3]:
            if rng.random() < 0.1:
                parts.insert(rng.randint(0, len(parts)), p)
        rows.append((i, " ".join(parts)))
    rows += [(n + i, t) for i, (_, t) in enumerate(rng.sample(rows, n // 8))]
    return rows


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = suffix.remove_repeats(df, **how)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()), key=repr), out


@pytest.mark.parametrize("split", [3, 4096])
def test_against_all_windows(spark, split):
    rows = corpus(1, 140, 0.4)
    got, _ = run(spark, rows, shard_segments=split)
    assert got == brute(rows)


def test_runs_of_one_byte_and_periods(spark):
    rows = [(1, "a" * 500), (2, "b" * 200), (3, "b" * 199), (4, "xyz" * 100), (5, "q" + "zxy" * 67), (6, "c" * 201), (7, None), (8, ""), (9, "é" * 150), (10, "\0" * 230)]
    for split in (3, 4096):
        got, _ = run(spark, rows, shard_segments=split)
        assert got == brute(rows)


def test_long_text_is_worked_on_in_pieces(spark, monkeypatch):
    rng = random.Random(2)
    piece = "".join(rng.choices("abcdefgh ", k=300))
    long = "".join(rng.choices("abcdefgh ", k=5000)) + piece + "".join(rng.choices("abcdefgh ", k=5000)) + piece
    import numpy as np

    whole = suffix.text_anchors(np.frombuffer(long.encode(), np.uint8), 200, 48)
    monkeypatch.setattr(suffix, "CHUNK", 1000)
    parts = suffix.text_anchors(np.frombuffer(long.encode(), np.uint8), 200, 48)
    assert sum(parts[3]) == sum(whole[3]) == len(long) - 199
    assert np.array_equal(np.repeat(parts[0], parts[3]), np.repeat(whole[0], whole[3]))


def test_rows(spark):
    same = "".join(random.Random(4).choices("abcdef ", k=400))
    rows = [(1, same, "s"), (1, same, "s"), (None, same + "x", "t"), (2, "short", "u"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_spans string")
    out = suffix.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()), key=repr)
    assert got == brute([r[:2] for r in rows])
    assert {bytes(r.kept_bytes) for r in out.collect()} == {b"", b"x", b"short"}
    assert suffix.remove_repeats(df.limit(0)).count() == 0
    assert suffix.remove_repeats(df.filter("doc_id = 2")).first().n_removed == 0


def test_suffix_array_and_prefixes():
    import numpy as np

    rng = random.Random(9)
    for _ in range(100):
        segments = [bytes(rng.choices(b"ab", k=rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        codes = np.concatenate([np.r_[np.frombuffer(s, np.uint8).astype(np.int16) + 1, 0] for s in segments])
        c = codes.tolist()
        order = suffix.suffix_array(codes)
        assert order.tolist() == sorted(range(len(c)), key=lambda i: c[i:])
        begin = np.cumsum([0, *[len(s) + 1 for s in segments[:-1]]])
        got = suffix.common_prefixes(codes, order, begin, begin + [len(s) for s in segments], 12)
        for k in range(1, len(c)):
            i, j, n = order[k], order[k - 1], 0
            while n < 12 and c[i + n] and i + n < len(c) and j + n < len(c) and c[i + n] == c[j + n]:
                n += 1
            assert got[k] == n
