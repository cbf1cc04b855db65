import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiplens.llm.periods import common_extension, digests, find_runs, grammar, periodic_runs
from shiplens.llm.queries import QUERIES
from tests.llm.conftest import SCHEMA, table, words


def brute_runs(w, least=24, power=3):
    """Every maximal stretch with smallest period q, by comparing words q apart."""
    n, best = len(w), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, power * q):
                best.setdefault((s, i + q), q)   # periods come in order: the first is the smallest
    return sorted((s, e - s, q) for (s, e), q in best.items())


def brute_row(doc_id, text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if x]
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    top = max(runs, key=lambda r: (__import__("fractions").Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def runs_of(*texts, **kw):
    letters = np.array([ord(c) for t in texts for c in t], dtype=np.uint64)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    doc, s, m, q = find_runs(letters, first, **kw)
    return [[(int(a), int(b), int(c)) for d, a, b, c in zip(doc, s, m, q) if d == k] for k in range(len(texts))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=4), st.integers(2, 9), st.integers(2, 4))
def test_runs_of_two_letters(texts, least, power):
    assert runs_of(*texts, least=least, power=power) == [brute_runs(t, least, power) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.text("abcd", min_size=1, max_size=7), st.integers(1, 30), st.text("abcd", max_size=12), st.text("abc", min_size=1, max_size=3), st.integers(1, 20))
def test_runs_inside_prose(unit, times, prose, other, more):
    t = prose + unit * times + prose[::-1] + other * more
    assert runs_of(t, "", prose) == [brute_runs(t), [], brute_runs(prose)]


@settings(max_examples=100, deadline=None)
@given(st.text("ab", min_size=2, max_size=40), st.data())
def test_extension_queries(t, data):
    i = data.draw(st.integers(0, len(t) - 2))
    j = data.draw(st.integers(i + 1, len(t) - 1))
    sym = np.array([7, *[ord(c) - 97 for c in t], 8], dtype=np.int64)
    levels = grammar(sym)
    want = next((k for k in range(len(t) - j) if t[i + k] != t[j + k]), len(t) - j)
    assert common_extension(levels, np.array([i + 1]), np.array([j + 1]))[0] == want
    back = [x.mirrored() for x in levels]
    want = next((k for k in range(i) if t[i - 1 - k] != t[j - 1 - k]), i)
    last = len(sym) - 1
    assert common_extension(back, np.array([last - j]), np.array([last - i]))[0] == want


@pytest.mark.parametrize("unit,times", [(1, 5000), (2, 4001), (37, 300), (911, 9)])
def test_long_runs(unit, times):
    rng = random.Random(unit)
    u = [rng.randrange(10**6) for _ in range(unit)]
    w = [rng.randrange(500) + 10**6 for _ in range(700)]
    t = w + u * times + w
    doc, s, m, q = find_runs(np.array(t, np.uint64), np.array([0, len(t)]))
    assert [(a, b, c) for a, b, c in zip(s.tolist(), m.tolist(), q.tolist())] == [(700, unit * times, unit)]


def test_grammar_is_small():
    sym = np.concatenate([[10**6], np.tile(np.arange(50), 400), [10**6 + 1]])
    levels = grammar(sym)
    assert len(levels) < 60 and sum(len(x.sym) for x in levels) < 8 * len(sym)


def extra_rows():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(1000, 1060):
        unit = words(rng, rng.choice([1, 2, 5, 9, 30]), vocab)
        t = "  ".join([words(rng, rng.randint(0, 30), vocab), *[unit] * rng.choice([2, 3, 5, 30]), "End\n" + words(rng, 5, vocab)])
        rows.append((i, t, "en", "a", len(t)))
    rows.append((-7, "la " * 100, "en", "a", 300))
    rows.append((1_000_000, "La la " * 40, "en", "a", 240))   # words are told apart by case
    return rows


def test_whole_rows_against_brute_force(spark, docs, wide_docs, no_docs):
    df = docs.unionByName(spark.createDataFrame(extra_rows(), SCHEMA)).repartition(3)
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = table(digests(periodic_runs(df, change=True)).select(*cols))
    key = lambda r: tuple((x is not None, x) for x in r)
    want = sorted((brute_row(r["doc_id"], r["text"]) for r in df.collect()), key=key)
    assert got == want and sum(r[1] > 0 for r in got) > 30
    assert table(digests(periodic_runs(wide_docs, change=True))) == table(digests(periodic_runs(docs, change=True)))
    assert table(digests(periodic_runs(no_docs, change=True))) == []
    plain = {r[0]: r[1] for r in table(periodic_runs(df).selectExpr("row.doc_id", "size(runs)"))}
    assert plain[-7] == 1 and plain[1_000_000] == 1


def test_registered_query(spark):
    df = QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001")
    rows = {r["doc_id"]: r for r in df.collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(docs)
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    for d in docs:
        if len(d["text"] or "") < 9000:
            assert tuple(rows[d["doc_id"]][c] for c in cols) == brute_row(d["doc_id"], d["text"])
