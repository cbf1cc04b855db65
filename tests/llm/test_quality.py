import random

import numpy as np
import pyarrow as pa

from shiplens.llm.quality import NAMES, PairwiseRanker, _cut, score, text_features, train
from tests.llm.conftest import SCHEMA, table, words


def labelled(n=240, seed=5):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in "ka lo mi nu pe".split() for b in "ban cel dor fin gul hem".split()]
    rows, labels = [], []
    for i in range(n):
        t = words(rng, rng.choice([20, 60, 200]), vocab)
        bad = i % 4 == 0
        if bad:
            t = [t.upper().replace(" ", "!! "), " ".join([t.split(" ")[0]] * 80), t.replace(" ", "### ")][i // 12 % 3]
        else:
            t = ". ".join(t.split(" ")).capitalize() if i % 5 == 0 else t
        rows.append((i, t, "en", "a", len(t)))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = labelled()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ranker = train(df, lab.filter("doc_id % 3 <> 1"))
    got = {r[0]: r[1:] for r in table(score(df, ranker), "row.doc_id", "score", "predicted")}
    held = [(q, got[i][1]) for i, q, _ in labels if i % 3 == 1]
    assert np.mean([q == p for q, p in held]) >= 0.95
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for s, p in got.values())
    again = train(df.repartition(6), lab.filter("doc_id % 3 <> 1"))
    assert np.array_equal(ranker.w, again.w)


def test_pairwise_loss_orders_a_linear_truth():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(NAMES)))
    y = (x[:, 0] - 2 * x[:, 3] + 0.1 * rng.normal(size=600) > 0.5).astype(int)
    r = PairwiseRanker().fit(x, y, float((y == 0).mean()))
    assert ((r.score(x) >= 0.5) == y).mean() > 0.95


def test_features_do_not_depend_on_neighbours():
    t = ["One two two.\nOne two two.\n", "", "ÉÉ é!! | x", "a " * 3000]
    whole = text_features(pa.array([*t, None]))
    for i, x in enumerate([*t, None]):
        assert np.allclose(whole[i], text_features(pa.array([x], pa.string()))[0])
    assert np.isfinite(whole).all() and np.allclose(whole[1], whole[4])


def test_edges(spark, docs, wide_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r for r in table(score(docs, train(docs, none)), "score", "predicted")} == {(0.5, 1)}
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert {r[0] for r in table(score(docs, train(docs, one)), "predicted")} == {1}
    ranker = train(docs, spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int"))
    got = table(score(docs, ranker), "row.doc_id", "score", "predicted")
    assert len(got) == docs.count() and got == table(score(wide_docs, ranker), "row.doc_id", "score", "predicted")
    assert table(score(no_docs, ranker), "score") == []


def test_conflicting_and_repeated_labels(spark):
    """A doc_id with both labels counts once for either, repeated labels once; the rest decides."""
    rows, labels = labelled()
    df = spark.createDataFrame(rows, SCHEMA)
    kind = "doc_id long, quality int, toxic int"
    plain = train(df, spark.createDataFrame(labels, kind))
    twice = train(df, spark.createDataFrame(labels + labels, kind))
    assert np.array_equal(plain.w, twice.w)
    both = train(df, spark.createDataFrame(labels + [(i, 1 - q, 0) for i, q, _ in labels[:6]], kind))
    got = {r[0]: r[1] for r in table(score(df, both), "row.doc_id", "predicted")}
    assert np.mean([got[i] == q for i, q, _ in labels[6:]]) >= 0.95


def test_score_by_brute_force(spark):
    """The query's scores are the ranker's, text by text, and the ranker's are its own formula."""
    rows, labels = labelled(90)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    r = train(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    for doc_id, s, p in table(score(df, r), "row.doc_id", "score", "predicted"):
        x = text_features(pa.array([rows[doc_id][1]]))[0]
        z = 0.0
        for j in range(len(NAMES)):
            z += r.w[j] * float(np.clip((x[j] - r.mean[j]) / r.std[j], -4, 4))
        at = len(NAMES)
        for j in range(len(NAMES)):
            z += r.w[at + int((r.edges[j] <= x[j]).sum())]
            at += r.edges.shape[1] + 1
        want = 1 / (1 + np.exp(-r.slope * (z - r.cut)))
        assert np.isclose(s, want, rtol=1e-9) and p == int(want >= 0.5)


def test_every_labelled_row_counts(spark):
    """With groups far smaller than the labels, means come from all rows and the cut has the labels' share below it."""
    rows, labels = labelled(240)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    r = train(df, lab, group=40)
    again = train(df.repartition(5), lab, group=40)
    assert np.array_equal(r.w, again.w) and (r.cut, r.slope) == (again.cut, again.slope)
    x, y = text_features(pa.array([t[1] for t in rows])), np.array([q for _, q, _ in labels])
    assert np.allclose(r.mean, np.mean([x[y == k].mean(axis=0) for k in (0, 1)], axis=0), atol=0.2 * r.std.max(), rtol=0.5)
    s = r.strength(x)
    assert (s < r.cut).sum() == (y == 0).sum() and np.isclose(r.slope, 2 / s.std())
    assert ((s >= r.cut) == y).mean() >= 0.95
    # one row of the rarer label fewer or other: a different model, whichever row it is
    for gone in (0, 100, 236):
        less = train(df, lab.filter(f"doc_id <> {gone}"), group=40)
        assert not np.array_equal(less.w, r.w)


def test_cut_by_brute_force(spark):
    rng = np.random.default_rng(4)
    for n, digits in ((500, 9), (500, 1), (3, 9)):
        s, y = np.round(rng.normal(size=n), digits), (rng.random(n) < 0.7).astype(int)
        y[:2] = 0, 1
        df = spark.createDataFrame([(int(q), float(v)) for q, v in zip(y, s)], "quality int, s double").repartition(3)
        bad = float((y == 0).mean())
        at = np.sort(s)
        k = int((y == 0).sum())
        want = (at[k - 1] + at[k]) / 2
        assert np.isclose(_cut(df, {1: 1 / n, 0: 1 / n}, bad, cells=8), want)
