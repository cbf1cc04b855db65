"""Operator 4 - benchmark decontamination by a prefix-filtered containment join.

An item's windows are its runs of ``window`` consecutive words (a shorter item is one
window).  A document is searched for every window's exact occurrences:

1. Item shingles (3 words) are ordered by rarity: one pass over all documents counts
   how often each occurs there.
2. A window can only occur where its rarest shingle does, so the join needs just that
   prefix token: document shingles look up the keys (an index of bounded size, see
   below).
3. Positional and length bounds place the whole window around the shingle and drop
   those that would start before or end behind their document.
4. Containment is verified exactly, word by word, over the window's length.

The index holds at most about ``BLOCK_BYTES`` of item text.  A larger benchmark is
searched in several such blocks, one pass over the documents for each; the spans found
so far travel with the document, so results are the same in any number of blocks.
Document text is never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx
from shiplens.session import materialize

WINDOW = 13
SHINGLE = 3
BLOCK_BYTES = 4 << 20


def _shingles(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(words with k words left in their row, hashes of the k-word shingles at every word)."""
    g = tx.gram_hashes(h, k)
    return np.flatnonzero(row[:len(g)] == row[k - 1:]) if len(g) else np.zeros(0, np.int64), g


class ItemIndex:
    """Windows of one block of items: word hashes, and per window its key shingle."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.ids = [i for i, _ in items]
        w = tx.Words(pa.array([t for _, t in items], pa.string()), tx.IS_ALNUM)
        self.seq = w.hashes()
        n = np.diff(w.first)
        start, length, item = [], [], []
        for i in range(len(items)):
            if n[i] == 0:
                continue
            k = min(int(n[i]), window)
            s = np.arange(w.first[i], w.first[i + 1] - k + 1)
            start.append(s)
            length.append(np.full(len(s), k))
            item.append(np.full(len(s), i))
        cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        start, length, item = cat(start), cat(length), cat(item)
        # equal windows once, with the items that have them
        whole = np.zeros(len(start), np.uint64)
        for k in np.unique(length):
            m = length == k
            whole[m] = tx.gram_hashes(self.seq, int(k))[start[m]]
        _, at, group = np.unique(whole, return_index=True, return_inverse=True)
        self.start, self.length = start[at], length[at]
        order = np.argsort(group, kind="stable")
        self.items, self.items_at = item[order], np.searchsorted(group[order], np.arange(len(at) + 1))
        self.short = np.minimum(self.length, SHINGLE)  # words of a window's shingles
        # the shingles of all windows, by length class
        self.tokens = {}
        for k in np.unique(self.short):
            k = int(k)
            g = tx.gram_hashes(self.seq, k)
            mine = np.flatnonzero(self.short == k)
            at = np.unique(np.concatenate([self.start[m] + np.arange(self.length[m] - k + 1) for m in mine]))
            self.tokens[k] = np.unique(g[at])

    def count(self, w: tx.Words) -> dict[int, np.ndarray]:
        """How often each item shingle occurs in a slice of documents."""
        h, out = w.hashes(), {}
        for k, tokens in self.tokens.items():
            pos, g = _shingles(h, w.row, k)
            at = np.searchsorted(tokens, g[pos])
            at[at == len(tokens)] = 0
            out[k] = np.bincount(at[tokens[at] == g[pos]], minlength=len(tokens))
        return out

    def choose(self, seen: dict[int, np.ndarray]) -> None:
        """Order shingles by rarity; each window's key is its rarest (the first of equals)."""
        self.keys = {}
        for k, tokens in self.tokens.items():
            g = tx.gram_hashes(self.seq, k)
            rank = seen[k]
            mine = np.flatnonzero(self.short == k)
            key, off = np.zeros(len(mine), np.uint64), np.zeros(len(mine), np.int64)
            for j, m in enumerate(mine.tolist()):
                own = g[self.start[m]:self.start[m] + self.length[m] - k + 1]
                o = int(np.argmin(rank[np.searchsorted(tokens, own)]))
                key[j], off[j] = own[o], o
            order = np.argsort(key, kind="stable")
            uniq, first = np.unique(key[order], return_index=True)
            self.keys[k] = (uniq, np.append(first, len(key)), mine[order], off[order])

    def occurrences(self, w: tx.Words) -> tuple[np.ndarray, np.ndarray]:
        """(window, start word) of every exact occurrence in a slice of documents."""
        h, found_w, found_s = w.hashes(), [], []
        for k, (uniq, first, window, off) in self.keys.items():
            pos, g = _shingles(h, w.row, k)
            at = np.searchsorted(uniq, g[pos])
            at[at == len(uniq)] = 0
            hit = np.flatnonzero(uniq[at] == g[pos])
            pos, at = pos[hit], at[hit]
            many = first[at + 1] - first[at]  # windows with this key
            p = np.repeat(pos, many)
            e = np.repeat(first[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            win, start = window[e], p - off[e]
            row = w.row[p]
            ok = (start >= w.first[row]) & (start + self.length[win] <= w.first[row + 1])
            win, start = win[ok], start[ok]
            for j in range(int(self.length[win].max()) if len(win) else 0):
                inside = j < self.length[win]
                same = np.ones(len(win), bool)
                same[inside] = h[start[inside] + j] == self.seq[self.start[win[inside]] + j]
                win, start = win[same], start[same]
            found_w.append(win)
            found_s.append(start)
        if not found_w:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_w), np.concatenate(found_s)


def _counter(index):
    def run(batches):
        ix, total = index.value, None
        for batch in batches:
            for part in tx.slices(batch, "text"):
                c = ix.count(tx.Words(tx.column(part, "text"), tx.IS_ALNUM))
                total = c if total is None else {k: total[k] + c[k] for k in c}
        for k, c in (total or {}).items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int64()),
                                              pa.array(c[at], pa.int64())], names=["k", "token", "seen"])
    return run


def _searcher(index):
    def run(batches):
        ix = index.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                w = tx.Words(tx.column(part, "text"), tx.IS_ALNUM)
                win, start = ix.occurrences(w)
                edge = np.zeros(len(w) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + ix.length[win], -1)
                before = tx.column(part, "spans")
                items = [set(x) for x in tx.column(part, "items").to_pylist()]
                for i, s in enumerate(before.to_pylist()):  # spans of the blocks searched before
                    for a, b in zip(s[::2], s[1::2]):
                        edge[w.first[i] + a] += 1
                        edge[w.first[i] + b] -= 1
                hit = np.cumsum(edge[:-1]) > 0
                total = np.concatenate([[0], np.cumsum(hit)])
                n_hit = total[w.first[1:]] - total[w.first[:-1]]
                for x, s in zip(win.tolist(), start.tolist()):
                    r = int(w.row[s])
                    items[r].update(ix.ids[j] for j in ix.items[ix.items_at[x]:ix.items_at[x + 1]])
                spans = []
                for i in range(part.num_rows):
                    a, b = int(w.first[i]), int(w.first[i + 1])
                    if not n_hit[i]:
                        spans.append([])
                        continue
                    x = np.flatnonzero(np.diff(np.concatenate([[False], hit[a:b], [False]])))
                    spans.append(x.tolist())
                yield pa.RecordBatch.from_arrays(
                    [tx.column(part, "row"), tx.column(part, "text"), pa.array(np.diff(w.first), pa.int64()),
                     pa.array(n_hit, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    names=["row", "text", "n_words", "n_hit", "spans", "items"])
    return run


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (row, n_words, n_hit, spans, items, contaminated) for every row of ``documents``.

    ``row`` is the input row as a struct; ``spans`` are the hit word ranges as a flat
    list start, end, start, end ...; ``items`` the sorted item_ids (as strings) with an
    occurring window.  A document is contaminated when it has a hit word and
    ``20 * n_hit >= n_words``.

    Defined cases: a null, empty or wordless text has 0 words and no hit.  Items without
    an item_id, text or words take no part; an item_id on several rows is one item with
    the windows of all of them.  Repeated document rows are judged one by one.  An empty
    benchmark hits nothing.  Further columns may have any name.
    """
    spark = documents.sparkSession
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("text").cast("string").alias("text"))
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    out = rows.select("row", "text", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                      F.expr("CAST(array() AS array<long>)").alias("spans"),
                      F.expr("CAST(array() AS array<string>)").alias("items"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("text", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.LongType())),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    for b in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        index = ItemIndex([(r[0], r[1]) for r in mine.collect()], window)  # about block_bytes
        shared = spark.sparkContext.broadcast(index)
        seen = {k: np.zeros(len(t), np.int64) for k, t in index.tokens.items()}
        counts = rows.select("text").mapInArrow(_counter(shared), "k int, token long, seen long") \
            .groupBy("k", "token").agg(F.sum("seen").alias("seen"))
        for r in counts.collect():  # one row per item shingle of the block
            seen[r["k"]][r["token"]] = r["seen"]
        index.choose(seen)
        shared.unpersist()
        found = spark.sparkContext.broadcast(index)
        out = out.select("row", "text", "spans", "items").mapInArrow(_searcher(found), schema)
        if blocks > 1:
            out = materialize(out)
    return out.select("row", "n_words", "n_hit", "spans", "items",
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
