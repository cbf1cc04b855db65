import random
import re

import pytest

from shiplens.llm.decontam import find_contamination
from tests.llm.conftest import SCHEMA, corpus, table, words


def tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items):
    windows = []
    for i, t in items:
        w = tokens(t)
        if i is not None and w:
            k = min(13, len(w))
            windows += [(str(i), tuple(w[s:s + k])) for s in range(len(w) - k + 1)]
    out = []
    for d, t, *_ in rows:
        w, hit, found = tokens(t), set(), set()
        for i, g in windows:
            for s in range(len(w) - len(g) + 1):
                if w[s] == g[0] and tuple(w[s:s + len(g)]) == g:
                    hit.update(range(s, s + len(g)))
                    found.add(i)
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def benchmark(rows):
    rng = random.Random(9)
    vocab = [f"q{i}" for i in range(50)]
    a, b = rows[5][1], rows[6][1]
    long_ = max((r[1] for r in rows if r[1]), key=len).split(" ")
    return [(1, " ".join(long_[500:530])), (2, a.upper()), (10, b), (3, words(rng, 40, vocab)), (4, None), (5, ""), (6, "--- !"),
            (None, a), (7, "é — 123"), (7, " ".join(long_[900:913]) + " zzz"), (8, " ".join(long_[500:520])), (9, long_[3])]


@pytest.mark.parametrize("block_bytes", [4 << 20, 200])
def test_equals_brute_force(spark, docs, wide_docs, block_bytes):
    rows = corpus()
    items = benchmark(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    df = docs if block_bytes > 200 else wide_docs
    got = table(find_contamination(df, bench, block_bytes=block_bytes), "row.doc_id", "n_words", "n_hit", "items", "contaminated")
    assert [(a, b, c, list(d), e) for a, b, c, d, e in got] == want
    assert sum(r[4] for r in want) > 5


def test_empty_tables(spark, docs, no_docs):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert table(find_contamination(no_docs, bench), "n_hit") == []
    none = find_contamination(docs, bench.limit(0))
    assert {r[0] for r in table(none, "n_hit")} == {0}


def test_one_word_item_and_bounds(spark):
    rows = [(1, "yes no yes", "", "", 0), (2, "no", "", "", 0), (3, " ".join(["no"] * 19 + ["yes"]), "", "", 0),
            (4, " ".join(["no"] * 20 + ["yes"]), "", "", 0)]
    bench = spark.createDataFrame([(11, "YES")], "item_id long, text string")
    got = table(find_contamination(spark.createDataFrame(rows, SCHEMA), bench), "row.doc_id", "n_hit", "contaminated")
    assert got == [(1, 2, True), (2, 0, False), (3, 1, True), (4, 1, False)]
