"""Operator 6 - quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in its features; in a preference pair the document
labelled 1 should beat the one labelled 0, with probability sigmoid(w . (x_good - x_bad)).
The weights minimise the logistic loss on feature differences of drawn pairs.  The cut
between good and bad is a quantile of the training scores: as many fall below it as
are labelled 0.  The reported score is a logistic curve around that cut.

Features are byte, word and line statistics of the whole text, each also as one-hot
quantile bins, so that too much and too little of something can both cost strength.
Training takes every labelled row: groups of about ``GROUP`` rows per label learn side by side, each row in at
least one pair, and their weights, means and bin edges are averaged; cut and slope come from the scores
of all of them.  Scoring is one scan without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx
from shiplens.session import materialize, release

GROUP = 3000             # rows of either label that learn together
CELLS = 1024             # score ranges counted at once in the search for the cut
PAIRS = 60_000
BINS = 8
STEPS, RATE, L2 = 400, 0.05, 1e-4

_CLASSES = {
    "upper": [range(65, 91)], "lower": [range(97, 123)], "digit": [range(48, 58)], "high": [range(128, 256)],
    "space": [b" \t\r\x0b\x0c"], "stop": [b".,;:"], "bang": [b"!?"], "odd": [b"#$%&*@^~<>|\\/{}[]=+_`"], "bar": [b"|"],
    "quote": [b"\"'()-"],
}
NAMES = [*_CLASSES, "log_bytes", "log_words", "word_bytes", "distinct_words", "repeat_next", "top_word", "capital_words",
         "long_words", "log_lines", "distinct_lines", "line_words", "short_lines", "odd_words", "distinct_pairs"]


def _share(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[off[1:]] - total[off[:-1]]).astype(float)


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: distinct values, and the count of its most frequent one."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    head = np.ones(len(v), bool)
    head[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(head)
    top = np.zeros(n)
    np.maximum.at(top, r[at], np.diff(np.append(at, len(v))))
    return np.bincount(r[at], minlength=n).astype(float), top


def text_features(arr: pa.Array) -> np.ndarray:
    """One row of statistics per text; an empty or null text has zeros (distinct shares are 1)."""
    raw, off = tx.text_bytes(arr)
    n = len(arr)
    size = np.maximum(np.diff(off), 1)
    cols = []
    for groups in _CLASSES.values():
        table = np.zeros(256, bool)
        for g in groups:
            table[list(g)] = True
        cols.append(_share(table[raw], off) / size)
    w, lines = tx.Words(arr), tx.Lines(arr)
    h = w.hashes()
    words = np.diff(w.first).astype(float)
    many = np.maximum(words, 1)
    distinct, top = _distinct(w.row, h, n)
    same = (h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1]) if len(h) else np.zeros(0, bool)
    pairs = tx.gram_hashes(h, 2)
    inside = w.row[1:] == w.row[:-1] if len(h) else np.zeros(0, bool)
    distinct2, _ = _distinct(w.row[:-1][inside], pairs[inside], n) if len(pairs) else (np.zeros(n), None)
    length = w.end - w.start
    odd = np.zeros(256, bool)
    odd[list(b"#$%&*@^~<>|\\{}=+!")] = True
    first = raw[w.start] if len(h) else np.zeros(0, np.uint8)
    last = raw[w.end - 1] if len(h) else np.zeros(0, np.uint8)
    count = lambda m: np.bincount(w.row[m], minlength=n)[:n].astype(float)
    n_lines = np.diff(lines.first).astype(float)
    full = lines.chars > 0
    some = np.bincount(lines.row[full], minlength=n)
    filled = np.maximum(some, 1)
    d_lines, _ = _distinct(lines.row[full], lines.hashes()[full], n)
    short = full & (lines.chars < 30)
    cols += [np.log1p(np.diff(off)), np.log1p(words), np.bincount(w.row, length, n) / many,
             np.where(words > 0, distinct / many, 1), (np.bincount(w.row[1:][same], minlength=n)[:n] if len(h) else np.zeros(n)) / many,
             top / many, count((first >= 65) & (first <= 90)) / many, count(length > 20) / many, np.log1p(n_lines),
             np.where(some > 0, d_lines / filled, 1), words / np.maximum(n_lines, 1),
             np.bincount(lines.row[short], minlength=n) / filled, count(odd[last]) / many,
             np.where(words > 1, distinct2 / np.maximum(words - 1, 1), 1)]
    return np.stack(cols, axis=1).astype(np.float64)


def statistics(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations and bin edges of the features."""
    return x.mean(axis=0), x.std(axis=0) + 1e-9, np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T


class PairwiseRanker:
    """Bradley-Terry weights on standardised features and their bins."""

    def __init__(self):
        self.mean = np.zeros(len(NAMES))
        self.std = np.ones(len(NAMES))
        self.edges = np.zeros((len(NAMES), 0))
        self.w = np.zeros(len(NAMES))
        self.cut, self.slope = 0.0, 1.0

    def expand(self, x: np.ndarray) -> np.ndarray:
        cols = [np.clip((x - self.mean) / self.std, -4, 4)]
        for j in range(x.shape[1]):
            if self.edges.shape[1]:
                cols.append(np.eye(self.edges.shape[1] + 1)[np.searchsorted(self.edges[j], x[:, j], side="right")])
        return np.concatenate(cols, axis=1)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.w

    def fit(self, x: np.ndarray, y: np.ndarray, share_bad: float, seed: int = 3) -> "PairwiseRanker":
        """``share_bad``: the share of label 0 among all labelled rows, the quantile of the cut."""
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        if not len(good) or not len(bad):
            return self.only(len(good) > 0)
        self.mean, self.std, self.edges = statistics(x)
        self.w = self.weights(x, y, seed)
        s = self.strength(x)
        # each label weighs what it has among all labelled rows
        weight = np.where(y == 1, (1 - share_bad) / len(good), share_bad / len(bad))
        order = np.argsort(s)
        upto = np.cumsum(weight[order])
        k = int(np.searchsorted(upto, share_bad - 1e-9))  # the last of those below the cut
        self.cut = float((s[order[min(k, len(s) - 1)]] + s[order[min(k + 1, len(s) - 1)]]) / 2)
        self.slope = 2.0 / (s.std() + 1e-9)
        return self

    def only(self, good: bool) -> "PairwiseRanker":
        """One label only: everything has it."""
        self.cut = -1.0 if good else 1.0
        return self

    def weights(self, x: np.ndarray, y: np.ndarray, seed: int) -> np.ndarray:
        """Weights learned from rows of both labels, each of them in a pair."""
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        z = self.expand(x)
        rng = np.random.default_rng(seed)
        pairs = max(PAIRS, len(good), len(bad))
        i, j = rng.choice(good, pairs), rng.choice(bad, pairs)
        for drawn, rows in ((i, good), (j, bad)):
            left = np.setdiff1d(rows, drawn)
            drawn[:len(left)] = left
        w, m1, m2 = np.zeros(z.shape[1]), 0.0, 0.0
        for step in range(1, STEPS + 1):
            pick = rng.integers(0, pairs, 2048)
            d = z[i[pick]] - z[j[pick]]
            g = -d.T @ (1 / (1 + np.exp(np.clip(d @ w, -30, 30)))) / len(pick) + L2 * w
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
            w = w - RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
        return w

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.strength(x) - self.cut), -30, 30)))


def _feature_rows(batches):
    for batch in batches:
        for part in tx.slices(batch, "text"):
            x = text_features(tx.column(part, "text"))
            yield pa.RecordBatch.from_arrays(
                [tx.column(part, "doc_id"), tx.column(part, "quality"), tx.list_array(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())],
                names=["doc_id", "quality", "x"])


def _rows(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a group, in an order that no plan changes."""
    got = pdf.assign(key=[tuple(v) for v in pdf["x"]]).sort_values(["doc_id", "quality", "key"])
    return np.array(got["key"].tolist(), dtype=np.float64).reshape(len(got), len(NAMES)), got["quality"].to_numpy()


def _grouped(rows: DataFrame, make) -> list[np.ndarray]:
    """``make(group, features, labels)`` (an array) of every group, by its number."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        g = int(pdf["g"].iloc[0])
        return pd.DataFrame({"g": [g], "v": [make(g, *_rows(pdf)).ravel().tolist()]})
    found = rows.groupBy("g").applyInPandas(run, "g int, v array<double>").collect()   # a few hundred numbers a group
    return [np.array(r["v"]) for r in sorted(found, key=lambda r: r["g"])]


def train(documents: DataFrame, labels: DataFrame, group: int = GROUP, seed: int = 3) -> PairwiseRanker:
    """Fit on ``documents`` (doc_id, text) joined to ``labels`` (doc_id, quality 0 or 1).

    Every labelled row is learned from, in a group that a hash of doc_id names; rows of the rarer label are in as
    many groups as it takes to have about ``group`` of either in each.  A doc_id with both labels
    counts once for either; repeated labels count once.
    """
    rows = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    counts = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    ranker = PairwiseRanker()
    if not counts:
        return ranker
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a number and a flag a labelled row are sent out, so that no text is shuffled
    x = materialize(texts.join(F.broadcast(rows.dropDuplicates()), "doc_id").select("doc_id", "quality", "text").mapInArrow(
        _feature_rows, "doc_id long, quality int, x array<double>"))
    have = {r["quality"]: r["n"] for r in x.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(have) < 2:
        release(x)
        return ranker.only(1 in have)
    groups = -(-max(have.values()) // group)
    copies = F.when(F.col("quality") == 1, min(groups, -(-groups * group // have[1]))).otherwise(min(groups, -(-groups * group // have[0])))
    copy = F.explode(F.sequence(F.lit(0), copies - 1))
    spread = x.select("*", copy.alias("copy")).select(
        "doc_id", "quality", "x", F.pmod(F.xxhash64(F.lit(seed), "doc_id") + F.col("copy"), F.lit(groups)).cast("int").alias("g"))
    seen = np.mean(_grouped(spread, lambda g, x, y: np.column_stack(statistics(x))), axis=0).reshape(len(NAMES), -1)
    ranker.mean, ranker.std, ranker.edges = seen[:, 0], seen[:, 1], seen[:, 2:]
    both = [w for w in _grouped(spread, lambda g, x, y: ranker.weights(x, y, seed + g) if 0 < y.sum() < len(y) else np.zeros(0)) if len(w)]
    ranker.w = np.mean(both, axis=0)
    model = documents.sparkSession.sparkContext.broadcast(ranker)

    def strengths(batches):
        for b in batches:
            if b.num_rows:
                flat = tx.column(b, "x").flatten().to_numpy().reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([tx.column(b, "quality"), pa.array(model.value.strength(flat))], names=["quality", "s"])
    s = materialize(x.select("quality", "x").mapInArrow(strengths, "quality int, s double"))
    exact = lambda c: F.sum(c.cast("decimal(28,12)")).cast("double")
    got = s.agg(exact(F.col("s")).alias("s"), exact(F.col("s") * F.col("s")).alias("ss")).first()
    n, bad = sum(have.values()), counts.get(0, 0) / sum(counts.values())
    ranker.slope = 2.0 / (max(got["ss"] / n - (got["s"] / n) ** 2, 0.0) ** 0.5 + 1e-9)
    ranker.cut = _cut(s, {1: (1 - bad) / have[1], 0: bad / have[0]}, bad)
    release(s)
    release(x)
    return ranker


def _cut(s: DataFrame, weight: dict, share: float, cells: int = CELLS) -> float:
    """Halfway between the last row (quality, s) up to which the rows weigh ``share`` and the next one; exact: the
    range of scores that holds it is counted in ``cells``, again and again, until it has few values."""
    held = lambda r: weight[0] * r["bad"] + weight[1] * r["good"]
    sums = [F.sum((F.col("quality") == q).cast("long")).alias(name) for q, name in ((0, "bad"), (1, "good"))]
    lo, hi = s.agg(F.min("s"), F.max("s")).first()
    below = 0.0
    while True:
        inside = s.where(F.col("s").between(lo, hi))
        values = inside.groupBy("s").agg(*sums)
        few = values.limit(cells + 1).collect()
        if len(few) <= cells:
            break
        cell = F.least(F.floor((F.col("s") - lo) / ((hi - lo) / cells)), F.lit(cells - 1))
        for r in sorted(inside.groupBy(cell.alias("c")).agg(*sums, F.min("s").alias("lo"), F.max("s").alias("hi")).collect(), key=lambda r: r["lo"]):
            if below + held(r) >= share - 1e-9 or r["hi"] == hi:
                lo, hi = r["lo"], r["hi"]
                break
            below += held(r)
    for r in sorted(few, key=lambda r: r["s"]):
        one = min(weight[q] for q, name in ((0, "bad"), (1, "good")) if r[name])
        if below + held(r) >= share - 1e-9 or r["s"] == hi:
            if below + held(r) - one >= share - 1e-9:
                return r["s"]                  # a further row of the same score follows
            after = s.where(F.col("s") > r["s"]).agg(F.min("s")).first()[0]
            return r["s"] if after is None else (r["s"] + after) / 2
        below += held(r)
    return hi


def _scorer(model):
    def run(batches):
        ranker = model.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                s = ranker.score(text_features(tx.column(part, "text")))
                yield pa.RecordBatch.from_arrays(
                    [tx.column(part, "row"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                    names=["row", "score", "predicted"])
    return run


def score(documents: DataFrame, ranker: PairwiseRanker) -> DataFrame:
    """Rows (row, score, predicted) for every row of ``documents``; only ``text`` is looked at.

    Defined cases: a null text scores like an empty one.  With labels of one kind only every
    row gets that label; without any label every score is 0.5 (predicted 1).  Repeated
    rows score alike; an empty table gives no rows; further columns may have any name.
    """
    model = documents.sparkSession.sparkContext.broadcast(ranker)
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("text").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(_scorer(model), schema)
