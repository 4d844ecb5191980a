import numpy as np

from corpusmill.llm import weak_quality as wq
from corpusmill.llm.catalog import op9_quality


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    p = truth.sum()
    return (rank[truth].sum() - p * (p + 1) / 2) / (p * (len(truth) - p))


def test_scores_agree_with_labels_never_seen(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in op9_quality(spark, sf).collect() if r.doc_id in label]
    truth = np.array([label[r.doc_id] == 1 for r in got])
    assert auc(np.array([r.score for r in got]), truth) > 0.95
    assert auc(np.array([r.weak_label for r in got]), truth) > 0.9
    assert np.mean([r.good for r in got] == truth) > 0.9


def test_estimation_finds_planted_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20000) < 0.7
    right = [0.95, 0.9, 0.8, 0.7, 0.6]
    v = np.stack([np.where(rng.random(len(truth)) < 0.2, 2, np.where(rng.random(len(truth)) < a, truth, ~truth)) for a in right], 1).astype(np.int8)
    rows, times = np.unique(v, axis=0, return_counts=True)
    model = wq.estimate(rows, times)
    assert abs(model.good - 0.7) < 0.03
    for j, a in enumerate(right):
        assert abs(model.chances[j, 1, 1] / model.chances[j, 1, :2].sum() - a) < 0.03


def test_rows(spark):
    rows = [(1, "Plain words make a good line of text.\n", "x"), (1, "Plain words make a good line of text.\n", "x"), (2, None, None), (3, "", "y"), (None, "@@@### $$$ %%%", "z"), (4, "ab " * 200_000, "w"), (5, "\n\n", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = wq.quality(df)
    assert out.columns == ["doc_id", "text", "votes", "weak_label", "score", "good"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and len(r.votes) == len(wq.LABELLERS) for r in got)
    assert all(r.score == 0 and not r.good for r in got if not (r.text or "").strip())
    assert len({(r.score, r.votes) for r in got if r.doc_id == 1}) == 1
    assert wq.quality(df.limit(0)).count() == 0


def test_lines_are_counted_per_text():
    import pyarrow as pa

    from corpusmill.llm.packed import pack

    texts = ["a.\nb", "c.", "", "d\n", "\n\n", "e.\n\nf!"]
    values, _ = wq.measures(*pack(pa.array(texts)))
    assert values[:, 4].tolist() == [0.5, 0, 0, 1, 0, 0]


def test_features_tell_words_and_byte_classes():
    import pyarrow as pa

    from corpusmill.llm.packed import pack

    def cells(*texts):
        data, off = pack(pa.array(texts))
        rows, cell, amount = wq.features(data, off, *wq.measures(data, off))
        assert cell.max() < wq.WIDTH
        return [{int(c): float(amount[(rows == i) & (cell == c)].sum()) for c in cell[rows == i]} for i in range(len(texts))]

    a, b, c, none, one = cells("nation ration", "motion ration", "nation, RATION", "", "x")
    whole = lambda x: {k for k in x if k < wq.CELLS}
    ends = lambda x: {k for k in x if wq.CELLS <= k < 2 * wq.CELLS}
    pairs = lambda x: {k: v for k, v in x.items() if 2 * wq.CELLS <= k < 2 * wq.CELLS + wq.PAIRS}
    assert len(whole(a)) == 2 and len(whole(a) & whole(b)) == 1  # whole words differ ...
    assert ends(a) == ends(b) and len(ends(a)) == 1  # ... that end alike
    assert pairs(a) == pairs(b) != pairs(c)
    assert abs(sum(pairs(c).values()) - 1) < 1e-9 and pairs(one) == pairs(none) == {}
    assert pairs(a)[2 * wq.CELLS + 3 * wq.CLASSES + 3] == 10 / 12
