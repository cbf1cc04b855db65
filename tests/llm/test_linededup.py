import hashlib
import re
from collections import defaultdict

import numpy as np

from shiplens.llm import linededup
from shiplens.llm.linededup import dedup_lines
from tests.llm.conftest import SCHEMA, corpus, table


def key(line):
    s = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, least=10):
    at = defaultdict(set)
    for d, t, *_ in rows:
        if d is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= least:
                    at[key(line)].add(d)
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or len(at[key(x)]) < 2 or min(at[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def got(df):
    return table(dedup_lines(df), "row.doc_id", "n_lines", "n_dropped", "kept")


def test_equals_brute_force(docs, wide_docs):
    want = brute(corpus())
    assert got(docs) == want and sum(r[2] for r in want) > 5
    assert got(wide_docs) == want
    assert dedup_lines(wide_docs).select("row.*").columns == wide_docs.columns


def test_a_full_filter_changes_nothing(docs, monkeypatch):
    monkeypatch.setattr(linededup, "MAX_BITS", 1 << 16)  # one slab
    monkeypatch.setattr(linededup, "MIN_BITS", 1 << 16)
    assert got(docs) == brute(corpus())


def test_empty_table(no_docs):
    assert got(no_docs) == []


def test_edges(spark):
    rows = [(3, "same old line\nx", "", "", 0), (1, "SAME old line \r\n\n\t\nsame old line", "", "", 0), (2, "\tsame old line", "", "", 0),
            (4, "ééééééééé\nnine char", "", "", 0), (5, "ééééééééé\nnine char", "", "", 0), (6, "éééééééééé", "", "", 0), (7, "éééééééééé\n", "", "", 0)]
    out = {r[0]: r for r in got(spark.createDataFrame(rows, SCHEMA))}
    assert out[1] == (1, 4, 0, rows[1][1])  # the first document keeps all of them, byte for byte
    assert out[2] == (2, 1, 1, "") and out[3] == (3, 2, 1, "x")
    assert out[4][2] == out[5][2] == 0      # nine code points are too short
    assert out[7] == (7, 2, 1, "")


def test_merging_keeps_every_repeat():
    """Merged filters hold what one filter over all parts would call repeated."""
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 60, 400).astype(np.uint64)
    parts = [h[:200], h[150:]]
    once, twice = np.zeros(1 << 13, np.uint8), np.zeros(1 << 13, np.uint8)
    for x in parts:
        p, q = linededup._positions(x, 1 << 16)
        a = np.zeros(1 << 13, np.uint8)
        linededup._add(a, p)
        linededup._add(a, q)
        twice |= once & a
        once |= a
    p, q = linededup._positions(h[150:200], 1 << 16)
    assert (linededup._has(twice, p) & linededup._has(twice, q)).all()


def test_query_hash(spark, docs):
    r = dedup_lines(docs).selectExpr("kept", "sha2(kept, 256) AS h").first()
    assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["h"]
