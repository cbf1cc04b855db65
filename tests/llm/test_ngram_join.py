import itertools
import random
import re

import numpy as np
import pytest

from shiplens.llm import ngram_join
from shiplens.llm.ngram_join import SignatureTree, forest, jaccard_classes, likely
from tests.llm.conftest import SCHEMA, corpus, table


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    rows = [(d, shingles(t, k)) for d, t, *_ in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        (a, s), (b, t) = rows[i], rows[j]
        if a is not None and b is not None and s and t and den * len(s & t) >= num * len(s | t):
            up[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    out = [(d, len(s), None if d is None else least[top(i)]) for i, (d, s) in enumerate(rows)]
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100)])
def test_equals_brute_force(docs, wide_docs, k, num, den):
    want = brute(corpus(), k, num, den)
    assert table(jaccard_classes(docs, k, num, den)) == want
    if k == 4:
        assert table(jaccard_classes(wide_docs, k, num, den)) == want


def test_empty_table(no_docs):
    assert table(jaccard_classes(no_docs)) == []


def test_large_blocks_are_dealt_into_chunks(spark, monkeypatch):
    """A group of near copies many times the chunk, in which not all are near each other."""
    monkeypatch.setattr(ngram_join, "CHUNK", 6)
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 6])):
            w[rng.randrange(60)] = rng.choice(vocab)
        rows.append((i, " ".join(w), "en", "a", 0))
    got = table(jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    want = brute(rows, 4, 85, 100)
    assert got == want and len({r[2] for r in want}) > 3


def test_tree_finds_exactly_the_linked_pairs():
    rng = np.random.default_rng(2)
    sets = []
    for i in range(90):
        if sets and i % 3:
            s = sets[rng.integers(len(sets))].copy()
            s[rng.integers(0, len(s), max(1, len(s) // 15))] = rng.integers(0, 1 << 40, max(1, len(s) // 15))
        else:
            s = rng.integers(0, 1 << 40, rng.integers(1, 120))
        sets.append(np.unique(s))
    want = {(i, j) for i, j in itertools.combinations(range(90), 2)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    got = {tuple(sorted(p)) for p in SignatureTree.of_sets(sets).pairs(85, 100).tolist()}
    assert got == want and want
    maps = [ngram_join.bitmap(s.astype(np.uint64)) for s in sets]
    kept = likely(np.array([len(s) for s in sets]), maps, 85, 100)
    assert want <= {tuple(sorted(p)) for p in kept.tolist()} and len(kept) < 400  # of 4005 pairs


def test_forest_connects_with_few_links():
    assert forest(5, np.array([[0, 3], [3, 4], [0, 4], [1, 2]])) == [(2, 1), (3, 0), (4, 0)]
