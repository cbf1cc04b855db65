"""Operator 11 - periodic runs of words, by recompression.

The words of a text are letters.  Block compression (a maximal stretch of one letter becomes
one new letter) and pair compression (letters are split into left and right ones; every
left letter followed by a right one becomes one new letter) alternate until no letter occurs
twice in its document.  The levels form a run-length grammar of the text whose blocks are
cut alike wherever the same words stand, so a longest-common-extension query walks up
while the letters at its two places agree and down again to the first word that differs:
a few array reads a level, for all queries of a batch at once, without a suffix array.

Candidates come from a harmonic grid: a run of period q is at least ``max(least, power * q)``
words long, so of the pairs (i, i + q) with i on a grid of that length less q, one lies inside
the run.  That is n / q places for each q, n log n in all.  Where the two words agree, the exact
extensions to both sides give the maximal interval of that period; of all periods
found for one interval the smallest is the run's.

A letter that occurs once in its document matches nothing, so stretches of such letters are one
wall each and shrink at once, and so does a letter that stands alone between two walls; prose is
all walls after two or three levels.  Letters are
numbered by document: copies of a text cost no more than other texts.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx

LEAST, POWER = 24, 3       # a run has at least so many words, and so many periods
CHUNK = 1 << 20            # grid places tested at once: bounds memory, cuts nothing off


class Level:
    """One level of the grammar: its letters and their blocks, which are the next level's letters.

    ``start``: first letter of each block and the length at the end; ``block``: block of each letter.
    """

    __slots__ = ("sym", "start", "block", "pairs")

    def __init__(self, sym, start, block, pairs):
        self.sym, self.start, self.block, self.pairs = sym, start, block, pairs

    def mirrored(self) -> "Level":
        n = len(self.sym)
        if self.start is None:
            return Level(self.sym[::-1], None, None, self.pairs)
        return Level(self.sym[::-1], n - self.start[::-1], len(self.start) - 2 - self.block[::-1], self.pairs)


def number(keys: np.ndarray, wall: np.ndarray) -> np.ndarray:
    """Equal numbers for equal keys; every wall has a number of its own."""
    out = np.empty(len(keys), np.int64)
    some = np.flatnonzero(~wall)
    names, inverse = np.unique(keys[some], return_inverse=True)
    out[some] = inverse
    out[wall] = len(names) + np.arange(int(wall.sum()))
    return out


def grammar(sym: np.ndarray) -> list[Level]:
    """Levels from the words up; the first and last letter must be walls (occur once)."""
    levels, pairs = [], False
    while True:
        wall = np.bincount(sym)[sym] == 1
        if wall.all():
            levels.append(Level(sym, None, None, pairs))
            return levels
        n = len(sym)
        head = np.ones(n, bool)
        if pairs:
            side = tx.mix64(sym.astype(np.uint64) + np.uint64(len(levels) << 40)) & np.uint64(1)
            head[1:] = ~(~wall[:-1] & ~wall[1:] & (side[:-1] == 0) & (side[1:] == 1))
        else:
            head[1:] = ~((sym[1:] == sym[:-1]) | (wall[1:] & wall[:-1]))
            if head.all():      # nothing to join: pairs of the same letters next
                pairs = True
                continue
        start = np.append(np.flatnonzero(head), n)
        size = np.diff(start)
        first = start[:-1]
        rest = np.where(size > 1, sym[np.minimum(first + 1, n - 1)] + 1, 0) if pairs else size
        levels.append(Level(sym, start, np.cumsum(head) - 1, pairs))
        gone = wall[first].copy()
        alone = ~gone[1:-1] & gone[:-2] & gone[2:]     # between walls: an extension that enters it ends behind it
        gone[1:-1] |= alone & ((size[1:-1] == 1) if pairs else True)
        sym = number((sym[first] << 32) | rest, gone)
        pairs = not pairs


def common_extension(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal letters from places i < j on, for each pair of places."""
    p, q, who = i.copy(), j.copy(), np.arange(len(i))
    differ = []  # by level: queries whose letters differ there, with their places
    for level in levels:
        same = level.sym[p] == level.sym[q]
        if level.start is not None and same.any():
            wp, wq, w = p[same], q[same], who[same]
            bp, bq = level.block[wp], level.block[wq]
            left_p, left_q = level.start[bp + 1] - wp, level.start[bq + 1] - wq
            inner = (level.start[bp] != wp) | (level.start[bq] != wq)  # the rest of a block is read letter by letter
            step = np.where(inner, np.minimum(left_p, left_q), 0)
            wp, wq = wp + step, wq + step
            stop = inner & (left_p != left_q) & (not level.pairs)
            differ.append((np.append(p[~same], wp[stop]), np.append(q[~same], wq[stop]), np.append(who[~same], w[stop])))
            go = ~stop
            p, q, who = level.block[wp[go]], level.block[wq[go]], w[go]
        else:  # in the last level no letter occurs twice
            differ.append((p, q, who))
            break
    p = q = who = np.zeros(0, np.int64)
    for k in range(len(differ) - 1, -1, -1):
        level = levels[k]
        if len(p):
            bp, bq = p, q
            p, q = level.start[bp], level.start[bq]
            same = level.sym[p] == level.sym[q]
            size = np.minimum(level.start[bp + 1] - p, level.start[bq + 1] - q)
            step = np.where(same, np.where(level.pairs, 1, size), 0)
            p, q = p + step, q + step
        p, q, who = np.append(differ[k][0], p), np.append(differ[k][1], q), np.append(differ[k][2], who)
    out = np.empty(len(i), np.int64)
    out[who] = p - i[who]
    return out


def _grid(begin: np.ndarray, n: np.ndarray, least: int, power: int):
    """Chunks of (place i, period q) for documents of ``n`` letters that begin at ``begin``."""
    most = np.where(n >= least, n // power, 0)
    doc = np.repeat(np.arange(len(n)), most)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(least, power * q) - q
    many = (n[doc] - q + step - 1) // step
    total = np.cumsum(many)
    at = 0
    while at < len(doc):
        end = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK, side="right")), at + 1)
        m = many[at:end]
        t = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        yield np.repeat(begin[doc[at:end]], m) + t * np.repeat(step[at:end], m), np.repeat(q[at:end], m)
        at = end


def find_runs(letters: np.ndarray, first: np.ndarray, least: int = LEAST, power: int = POWER):
    """Runs (document, start, length, period), ordered, of documents laid end to end.

    ``letters`` are any 64-bit names of the words, equal for equal words; ``first`` holds the n + 1
    offsets of the documents.  ``power`` must be 2 or more.
    """
    n = np.diff(first)
    docs = len(n)
    row = np.repeat(np.arange(docs), n)
    none = np.zeros(0, np.int64)
    if not (n >= max(least, power)).any():
        return none, none, none, none
    # a wall before each document and one at the end; letters are numbered by document
    order = np.lexsort((letters, row))
    r, v = row[order], letters[order]
    head = np.ones(len(v), bool)
    head[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    ids = np.empty(len(v), np.int64)
    ids[order] = np.cumsum(head) - 1
    place = np.arange(len(ids)) + row + 1
    sym = np.empty(len(ids) + docs + 1, np.int64)
    sym[place] = ids
    walls = np.append(first[:-1] + np.arange(docs), len(sym) - 1)
    sym[walls] = int(head.sum()) + np.arange(docs + 1)
    levels = grammar(sym)
    back = [x.mirrored() for x in levels]
    last = len(sym) - 1
    found = []
    for i, q in _grid(walls[:-1] + 1, n, least, power):
        hit = sym[i] == sym[i + q]
        i, q = i[hit], q[hit]
        start = i - common_extension(back, last - (i + q) + 1, last - i + 1)
        end = i + q + common_extension(levels, i, i + q)
        whole = end - start >= np.maximum(least, power * q)
        found.append(np.stack([start[whole], end[whole], q[whole]]))
    start, end, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    keep = np.ones(len(q), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[keep], end[keep], q[keep]
    doc = np.searchsorted(walls, start, side="right") - 1
    start = start - walls[doc] - 1
    order = np.lexsort((q, start, doc))
    return doc[order], start[order], (end - walls[doc] - 1)[order] - start[order], q[order]


def stretched(keys: list, first: np.ndarray) -> np.ndarray:
    """Index of the original word at each place: every tenth document by crc32 ends periodically.

    With h = crc32 of the decimal key, g = h // 10 and h % 10 = 0, word i >= a becomes word
    a + (i - a) % p, a = g % n, p = 1 + (n - a) // (3 + g % 8).  A null key changes nothing.
    """
    src = np.arange(int(first[-1]))
    for d, key in enumerate(keys):
        lo, n = int(first[d]), int(first[d + 1] - first[d])
        if n and key is not None:
            h = zlib.crc32(str(key).encode())
            if h % 10 == 0:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                src[lo + a:lo + n] = lo + a + np.arange(n - a) % p
    return src


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The byte ranges, one space behind each; and where each ends (its space included)."""
    size = end - start + 1
    stop = np.cumsum(size)
    at = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(start - (stop - size), size)
    out = data[np.minimum(at, len(data) - 1)] if len(data) else np.zeros(0, np.uint8)
    out[stop - 1] = 32
    return out.tobytes(), stop


def _slice_runs(keys: list, texts: pa.Array, least: int, power: int, change: bool) -> dict[str, pa.Array]:
    w = tx.Words(texts)
    w.data = tx.text_bytes(texts)[0]      # words are told apart as they stand
    src = stretched(keys, w.first) if change else np.arange(len(w))
    letters = w.hashes()[src]
    doc, start, length, period = find_runs(letters, w.first, least, power)
    n = len(keys)
    # words inside a run, after its first period, are dropped
    depth = np.zeros(len(w) + 1, np.int64)
    base = w.first[doc]
    np.add.at(depth, base + start + period, 1)
    np.add.at(depth, base + start + length, -1)
    keep = np.cumsum(depth[:-1]) == 0
    kept = src[keep]
    text, stop = _joined(w.data, w.start[kept], w.end[kept])
    upto = np.concatenate([[0], np.cumsum(keep)])[w.first]     # kept words before each document
    cut = np.concatenate([[0], stop])[upto]
    at = np.searchsorted(doc, np.arange(n + 1))
    collapsed, runs = [], []
    for d in range(n):
        a, b = int(cut[d]), int(cut[d + 1])
        collapsed.append(text[a:max(a, b - 1)])
        runs.append([{"start": s, "length": m, "period": q} for s, m, q in zip(
            start[at[d]:at[d + 1]].tolist(), length[at[d]:at[d + 1]].tolist(), period[at[d]:at[d + 1]].tolist())])
    return {"runs": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
            "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string())}


def _finder(least: int, power: int, change: bool):
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                got = _slice_runs(tx.column(part, "key").to_pylist(), tx.column(part, "text"), least, power, change)
                yield pa.RecordBatch.from_arrays([tx.column(part, "row"), got["runs"], got["collapsed"]], names=["row", "runs", "collapsed"])
    return run


def periodic_runs(documents: DataFrame, least: int = LEAST, power: int = POWER, change: bool = False) -> DataFrame:
    """Rows (row, runs, collapsed): every periodic run of words of every whole text, and the text without repeats.

    ``runs`` is a list of (start, length, period), ordered by start, then period; ``collapsed``
    the words that no run repeats, joined by one space.  With ``change``, one document in ten, by crc32
    of its doc_id, is given a periodic end first (see ``stretched``).  One scan without a shuffle; memory
    is bounded by the longest text.

    Defined cases: null, empty and blank texts have no words, no runs and an empty ``collapsed``; a
    null doc_id is never changed; repeated rows get equal answers; an empty table gives no
    rows; further columns may have any name.
    """
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("runs", T.ArrayType(run)),
                           T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_finder(least, power, change), schema)


def digests(found: DataFrame) -> DataFrame:
    """Per document: number of runs, the run of the greatest exponent, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    # exact comparison of length / period by cross products; the first in order wins ties
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    text = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), text.alias("lines"), "collapsed").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
