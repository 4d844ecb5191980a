import random
import re

import numpy as np
import pytest

from corpusmill.llm import partenum
from corpusmill.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def shingles(t):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
    w = WORD.findall(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """rows of (id, text) -> sorted (id, size, component)"""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                up[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        own = [x for x in ids[top(i)] if x is not None]
        out.append((d, len(sets[i]), (min(own) if own else None) if sets[i] else d))
    return sorted(out, key=repr)


def near_copies(seed, n, hot):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    while len(rows) < n:
        base = rng.choices(vocabulary, k=rng.choice([3, 5, 6, 8, 12, 30, 80, 200]))
        if rng.random() < hot:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n"]).join(w)))
    rng.shuffle(rows)
    return rows[:n]


@pytest.mark.parametrize(("seed", "frequent"), [(1, 2)])
def test_against_all_pairs(spark, seed, frequent):
    rows = near_copies(seed, 600, 0.4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in partenum.similarity_components(df, frequent=frequent).collect()), key=repr)
    assert got == brute(rows)


def test_one_group_of_a_third_of_all_rows(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(600):
        w = list(base) if i % 3 == 0 else rng.choices([f"w{j}" for j in range(400)], k=100)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in partenum.similarity_components(df).collect()), key=repr)
    assert got == brute(rows)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (None, "a b c d e f"), (7, "A b c d e f"), (7, "A b c d e f"), (None, "only null"), (None, "only null"), (8, "q " * 60_000), (9, "q q q q q"), (10, "é\x0bü")]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "s", 1) for r in ODD], "doc_id long, text string, component_id string, _ka int")
    out = partenum.similarity_components(df)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute(ODD)
    kept = partenum.drop_similar(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 6, 7, 7, 8, 10]
    assert partenum.similarity_components(df.limit(0)).count() == 0
    assert partenum.drop_similar(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 120)]
    star = [(5, i) for i in range(300, 500)]
    links = chain + star + [(7, 7), (120, 499)]
    links = [x for x in links if x[0] != x[1]] + [(7, 7)]
    rng.shuffle(links)
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 5 for i in [*range(100, 121), *range(300, 500), 5]}
    assert got == want


def test_similar_sets_share_more_signatures_than_the_spare_ones():
    import numpy as np

    rng, bands, met = random.Random(7), partenum.Bands((75, 100)), 0
    for _ in range(1500):
        a = {rng.getrandbits(64) for _ in range(rng.choice([3, 4, 5, 8, 15, 40, 120, 400]))}
        b = set(a) - set(rng.sample(sorted(a), rng.randint(0, len(a) // 4)))
        b |= {rng.getrandbits(64) for _ in range(rng.randint(0, len(a) // 6 + 1))}
        if a == b or 100 * len(a & b) < 75 * len(a | b):
            continue
        band = bands.band(max(len(a), len(b)))
        one, two = (dict((t, set(s.tolist())) for t, s, _ in partenum.signatures(np.array(sorted(x), np.uint64), bands)) for x in (a, b))
        assert len(one[band] & two[band]) > bands.spare[band]
        met += 1
    assert met > 400


def test_fine_sketches_never_rule_out_a_near_pair():
    rng = np.random.default_rng(11)
    for _ in range(200):
        one = rng.integers(0, 2**64, rng.integers(1, 3000), dtype=np.uint64)
        two = np.r_[one[rng.random(len(one)) < rng.random()], rng.integers(0, 2**64, rng.integers(1, 500), dtype=np.uint64)]
        one, two = np.unique(one), np.unique(two)
        differ = len(np.setxor1d(one, two))
        assert partenum.apart(partenum.fine_sketch(one), partenum.fine_sketch(two)) <= differ
    same = np.arange(1, 400, dtype=np.uint64) << np.uint64(32)  # one cell, over its bound
    more = np.arange(1, 900, dtype=np.uint64) << np.uint64(32)
    assert partenum.apart(partenum.fine_sketch(same), partenum.fine_sketch(more)) <= 500
    other = np.unique(rng.integers(0, 2**64, 900, dtype=np.uint64))
    assert partenum.apart(partenum.fine_sketch(more), partenum.fine_sketch(other)) <= 900 + 899
    far = np.unique(rng.integers(0, 2**64, 1000, dtype=np.uint64))
    assert partenum.apart(partenum.fine_sketch(far), partenum.fine_sketch(other)) > 500  # strangers are told apart
