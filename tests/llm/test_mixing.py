import numpy as np
import pytest

from shiplens.llm.mixing import mix_sources, sainte_lague, sized, source_targets
from tests.llm.conftest import SCHEMA, corpus, table


def by_seat(w, seats, most):
    got = [0] * len(w)
    for _ in range(seats):
        open_ = [i for i in range(len(w)) if w[i] > 0 and got[i] < most[i]]
        if not open_:
            break
        best = max(open_, key=lambda i: (w[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


@pytest.mark.parametrize("seed", range(12))
def test_sainte_lague_is_the_seat_by_seat_rule(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 9))
    w = rng.integers(0, 60, n).astype(float) if seed % 2 else rng.random(n) * 1000
    seats, most = int(rng.integers(0, 300)), rng.integers(0, 120, n)
    assert sainte_lague(w, seats, most).tolist() == by_seat(w, seats, most)


def shares(sizes, cap=3):
    """The contract's procedure: share, cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / w for s in names}
        more = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not more:
            return target
        full |= more


@pytest.mark.parametrize("sizes", [{"a": 900, "b": 10, "c": 20, None: 70}, {"a": 5}, {"x": 0, "y": 50}, {"x": 0},
                                   {"z": 100, "B": 100, "b": 100, None: 1, "é": 4}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r[0]: r[2] for r in source_targets(df).collect()}
    assert got == pytest.approx(shares(sizes))


def test_mix(spark, docs, wide_docs):
    got = table(mix_sources(docs))
    assert got == table(mix_sources(wide_docs.repartition(7)))  # another plan, the same rows
    rows = corpus()
    size = {}
    for d, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len((t or "").replace("\x0b", " ").split())
    assert len(got) == len(rows)
    assert all(0 <= taken <= 3 * n for _, n, _, _, taken in got)
    want, taken = shares(size), {}
    for (d, n, ss, target, k) in got:
        taken[target, ss] = taken.get((target, ss), 0) + k
    for s, t in want.items():
        mine = [v for (x, ss), v in taken.items() if ss == size[s] and x == pytest.approx(t)]
        assert any(abs(v - t) <= (1 if t < 16 * 32 else 32) for v in mine), (s, t, taken)


def test_small_shards(docs):
    """Many shards a source: quotas of the shards add up to the source's blocks."""
    got = table(mix_sources(docs, shard_words=500, block=8))
    whole = table(mix_sources(docs, block=8))
    assert [r[:4] for r in got] == [r[:4] for r in whole]
    assert abs(sum(r[4] for r in got) - sum(r[4] for r in whole)) <= 8 * 80


def test_words_and_empty(spark, no_docs):
    assert table(mix_sources(no_docs)) == []
    df = spark.createDataFrame([(1, None, "", "a", 0), (2, "a\x0bb c  d", "", "a", 0)], SCHEMA)
    assert table(sized(df), "doc_id", "size") == [(1, 0), (2, 3)]
    assert table(mix_sources(df.limit(0).unionAll(df.filter("doc_id = 1"))), "taken", "target") == [(0, 0.0)]


def test_tiny_sources(spark):
    """Sources of a few words get their words, not none: targets below 16 blocks are apportioned by the word."""
    rows = [(i, "x " * 40, "", "big", 0) for i in range(50)] + [(100, "one two three four five", "", "five", 0), (101, "w " * 12, "", "twelve", 0), (102, "w", "", None, 0)]
    got = {r[0]: (r[1], r[2]) for r in mix_sources(spark.createDataFrame(rows, SCHEMA)).groupBy("source_size").agg(
        {"target": "max", "taken": "sum"}).select("source_size", "max(target)", "sum(taken)").collect()}
    want = shares({"big": 2000, "five": 5, "twelve": 12, None: 1})
    assert {k: v[0] for k, v in got.items()} == pytest.approx({2000: want["big"], 5: want["five"], 12: want["twelve"], 1: want[None]})
    assert got[5][1] == 15 and got[12][1] == 36 and got[1][1] == 3 and abs(got[2000][1] - want["big"]) <= 32


def test_null_and_repeated_ids_spread(spark, monkeypatch):
    """Thousands of equal rows without doc_id are dealt over all shards, and reruns agree."""
    from shiplens.llm import mixing
    rows = [(None, "a b c d e f g h", "", "s", 0)] * 600 + [(7, f"w{i} b", "", "s", 0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(mixing, "RANGE", 4)
    a = table(mix_sources(df, shard_words=200, block=8))
    assert a == table(mix_sources(df.repartition(5), shard_words=200, block=8)) and len(a) == 800
    assert abs(sum(r[4] for r in a) - 5200) <= 8 and all(r[4] <= 3 * r[1] for r in a)
