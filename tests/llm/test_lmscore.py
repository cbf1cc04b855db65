import random

import numpy as np
import pyarrow as pa

from shiplens.llm import lmscore
from shiplens.llm.lmscore import WindowNetwork, _words, score, train, vocabulary
from tests.llm.conftest import SCHEMA, table, words


def test_gradient():
    """The backward pass agrees with finite differences of the log-probability."""
    net = WindowNetwork(np.arange(1, 60, dtype=np.uint64))
    rng = np.random.default_rng(0)
    net.p = {k: rng.normal(size=v.shape) * 0.3 for k, v in net.p.items()}
    ctx, target = rng.integers(0, 200, (5, 2 * lmscore.WINDOW)), rng.integers(0, 200, 5)
    old = {k: v.copy() for k, v in net.p.items()}
    seen = {k: np.zeros_like(v) for k, v in net.p.items()}
    net.step(ctx, target, seen)
    for k in ("E", "C", "b", "Wc", "bc", "Wt", "bt"):
        i = np.unravel_index(np.argmax(seen[k]), seen[k].shape)
        slope = []
        for e in (1e-5, -1e-5):
            net.p = {a: v.copy() for a, v in old.items()}
            net.p[k][i] += e
            slope.append(-net.log_prob(ctx, target).mean())
        assert np.isclose(abs(slope[0] - slope[1]) / 2e-5, np.sqrt(seen[k][i]), rtol=2e-3), k


def test_probabilities_sum_to_one():
    net = WindowNetwork(np.arange(1, 60, dtype=np.uint64))
    ctx = np.repeat(np.array([[3, 5, lmscore.VOCAB, 0]]), lmscore.VOCAB, axis=0)
    assert np.isclose(np.exp(net.log_prob(ctx, np.arange(lmscore.VOCAB))).sum(), 1, atol=1e-4)


def brute(net, text):
    w = _words(pa.array([text], pa.string()))
    ids = net.tokens(w)
    total = 0.0
    for t in range(len(ids)):
        near = [ids[t + o] if 0 <= t + o < len(ids) else lmscore.VOCAB for o in (*range(-lmscore.WINDOW, 0), *range(1, lmscore.WINDOW + 1))]
        z = net.p["b"] + sum(net.p["E"][n] * net.p["C"][j] for j, n in enumerate(near))
        h = np.tanh(z)
        a, c = h @ net.p["Wc"] + net.p["bc"], ids[t] // lmscore.PER_CLASS
        b = h @ net.p["Wt"][c] + net.p["bt"][c]
        total += a[c] - np.log(np.exp(a).sum()) + b[ids[t] % lmscore.PER_CLASS] - np.log(np.exp(b).sum())
    return total


def text_rows(n=60):
    rng = random.Random(8)
    order = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(n):
        s = rng.randrange(12)
        rows.append((i, " ".join(order[(s + j) % 12] for j in range(150)), "en", "a", 0))  # each word follows from its neighbours
    return rows


def test_learns_and_scores(spark):
    rows = text_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    net = train(df, rate=1.0, rounds=3)
    shuffled = list(rows[0][1].split(" "))
    random.Random(1).shuffle(shuffled)
    more = spark.createDataFrame([(0, rows[0][1], "", "", 0), (1, " ".join(shuffled), "", "", 0), (2, "W0 w1, zzz", "", "", 0)], SCHEMA)
    got = table(score(more, net), "row.doc_id", "n_tokens", "n_unknown", "log_likelihood")
    assert got[0][3] > got[1][3] + 100           # order matters
    assert got[2][1:3] == (3, 1)
    for (_, _, _, x), t in zip(got, (rows[0][1], " ".join(shuffled), "W0 w1, zzz")):
        assert np.isclose(x, brute(net, t), rtol=1e-4)


def test_vocabulary_counts_all_documents(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 50, ["aa"] * 5 + ["bb"] * 3 + ["cc"]), "", "", 0) for i in range(30)]
    got = vocabulary(spark.createDataFrame(rows, SCHEMA).select("text").repartition(4))
    assert got.tolist() == _words(pa.array(["aa bb cc"])).hashes().tolist()


def test_edges(docs, wide_docs, no_docs):
    net = train(docs, rate=0.5, rounds=1)
    got = table(score(docs, net), "row.doc_id", "n_tokens", "log_likelihood")
    assert len(got) == docs.count() and got == table(score(wide_docs, net), "row.doc_id", "n_tokens", "log_likelihood")
    assert all(x == 0 for _, n, x in got if n == 0) and any(n == 0 for _, n, _ in got)
    empty = train(no_docs)
    assert table(score(no_docs, empty), "n_tokens") == []


def test_default_trains_on_every_window(spark):
    df = spark.createDataFrame(text_rows(20), SCHEMA).repartition(3)
    assert train(df).windows == 20 * 150


def test_vocabulary_grows_and_sums_to_one():
    assert lmscore.vocabulary_size(10 ** 4) == lmscore.VOCAB and lmscore.vocabulary_size(10 ** 8) == 8192
    net = WindowNetwork(np.arange(1, 8192, dtype=np.uint64))
    assert net.size == 8192
    ctx = np.repeat(np.array([[3, 5, net.size, 0]]), net.size, axis=0)
    assert np.isclose(np.exp(net.log_prob(ctx, np.arange(net.size))).sum(), 1, atol=1e-4)
    table = lmscore.spelling_table(np.arange(lmscore.PAIRS, dtype=float)).reshape(lmscore.EDGE + 1, -1)
    assert np.allclose(np.exp(table).sum(axis=1), 1)


def test_words_without_an_id_are_told_apart(spark):
    rng = random.Random(4)
    rare = ["".join(rng.choice("bdglmnr") + rng.choice("aeiou") for _ in range(4)) for _ in range(4000)]
    df = spark.createDataFrame([(i, " ".join(rare[20 * i:20 * i + 20]), "", "", 0) for i in range(200)], SCHEMA).repartition(3)
    net = train(df)
    unseen = [("".join(rng.choice("bdglmnr") + rng.choice("aeiou") for _ in range(5)) + " ") * 6 for _ in range(2)]
    texts = [*unseen, "xq9zkwvhtq " * 6]
    got = table(score(spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA), net),
                "row.doc_id", "n_tokens", "n_unknown", "log_likelihood")
    assert [r[1:3] for r in got] == [(6, 6)] * 3
    assert got[0][3] != got[1][3] and min(got[0][3], got[1][3]) > got[2][3] + 50
    net.spelling, spelt = None, net.spelling
    flat = table(score(spark.createDataFrame([(0, texts[0], "", "", 0)], SCHEMA), net), "log_likelihood")[0][0]
    word = [256, *texts[0].split()[0].encode(), 256]
    assert np.isclose(got[0][3] - flat, 6 * sum(spelt[a * 257 + b] for a, b in zip(word, word[1:])))


def spelled(net, text):
    """Spelling of the words without an id, byte pair by byte pair."""
    w = _words(pa.array([text], pa.string()))
    total = 0.0
    for i, k in enumerate(net.tokens(w)):
        if k == 0:
            b = [lmscore.EDGE, *w.text(i), lmscore.EDGE]
            total += sum(net.spelling[x * (lmscore.EDGE + 1) + y] for x, y in zip(b, b[1:]))
    return total


def test_words_without_id_by_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(900) if rng.random() < .7 else rng.randrange(9000)}x" for _ in range(300)), "en", "a", 0) for i in range(50)]
    net = train(spark.createDataFrame(rows, SCHEMA).repartition(2))
    some = rows[:4] + [(100, "neverseen w1x été w8999x", "en", "a", 0)]
    got = table(score(spark.createDataFrame(some, SCHEMA), net), "row.doc_id", "n_unknown", "log_likelihood")
    assert sum(n for _, n, _ in got) > 100
    for (_, n, x), r in zip(got, some):
        assert np.isclose(x, brute(net, r[1]) + spelled(net, r[1]), rtol=1e-4)


def test_two_splits_order_texts_alike(spark):
    """Networks of different splits differ in level, not in what they prefer."""
    rows = text_rows(240)
    df = spark.createDataFrame(rows, SCHEMA)
    rng, mixed = random.Random(3), []
    for i, t, *_ in rows[:30]:
        w = t.split(" ")
        rng.shuffle(w)
        mixed += [(2 * i, t, "", "", 0), (2 * i + 1, " ".join(w), "", "", 0)]
    for n in (2, 5):
        got = [r[1] for r in table(score(spark.createDataFrame(mixed, SCHEMA), train(df.repartition(n), rounds=3)), "row.doc_id", "log_likelihood")]
        assert all(a > b for a, b in zip(got[::2], got[1::2])), n


def test_large_scores_do_not_overflow():
    net = WindowNetwork(np.arange(1, 60, dtype=np.uint64))
    net.p["bc"][0] = 500.0
    net.p["bt"][:, 1] = -500.0
    ctx = np.array([[3, 5, 7, 0]])
    assert np.isfinite(net.log_prob(ctx, np.array([3]))).all()
    seen = {k: np.full_like(v, 1e-4) for k, v in net.p.items()}
    net.step(ctx, np.array([lmscore.PER_CLASS + 1]), seen)
    assert all(np.isfinite(v).all() for v in net.p.values())


def test_a_step_moves_each_weight_once(monkeypatch):
    """The classes' gradients are gathered and moved together, whether a batch meets some of the classes or all."""
    calls = []
    move = WindowNetwork._move
    monkeypatch.setattr(WindowNetwork, "_move", lambda self, k, *a: (calls.append(k), move(self, k, *a)))
    for met in (np.arange(lmscore.VOCAB), np.arange(lmscore.PER_CLASS, 3 * lmscore.PER_CLASS)):
        net = WindowNetwork(np.arange(1, 60, dtype=np.uint64))
        seen, old = {k: np.zeros_like(v) for k, v in net.p.items()}, net.p["Wt"].copy()
        calls.clear()
        net.step(np.repeat(met[:, None], 2 * lmscore.WINDOW, axis=1), met, seen)
        assert sorted(calls) == sorted(net.p)
        moved = np.flatnonzero((net.p["Wt"] != old).any(axis=(1, 2)))
        assert moved.tolist() == sorted(set((met // lmscore.PER_CLASS).tolist()))
