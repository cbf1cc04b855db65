"""Operator 3 - language identification with a linear-chain conditional random field.

Words of a text form a chain; each word's label scores come from affix, byte n-gram and
lexicon (whole word) features, hashed into one weight table, and learned transitions
link neighbours.  Forward-backward gives every word's label marginals, so words of
code-switched text get labels of their own; a document's language is the one with the
largest summed marginal, its score that sum's share.

Training takes a bounded sample of labelled rows (``SAMPLE_DOCS`` in all, spread evenly
over the languages, texts up to ``SAMPLE_CHARS`` characters where a language has any),
fitted in numpy by Adam on the log-likelihood.  Prediction is one scan without a shuffle: all words of a slice of
the batch are scored at once, each distinct word's features once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx

BUCKETS = 1 << 18
SEGMENT = 64              # words of a chain; longer texts are several chains
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 10_000
EPOCHS, BATCH, RATE, L2 = 5, 1024, 0.05, 1e-6
UNKNOWN = "und"


def _lowered(arr: pa.Array) -> pa.Array:
    return pc.utf8_lower(arr.fill_null("") if arr.null_count else arr)


def features(w: tx.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of the words ``at`` as (flat buckets, n + 1 offsets)."""
    s, e = w.start[at], w.end[at]
    n = e - s
    parts, owner = [], []

    def add(h, tag, who):
        parts.append((tx.mix64(h + np.uint64(tag * 0x9E3779B97F4A7C15 % (1 << 64))) & np.uint64(BUCKETS - 1)).astype(np.int64))
        owner.append(who)
    every = np.arange(len(at))
    add(w.hash_ranges(s, e), 1, every)                              # lexicon
    for i, k in enumerate((2, 3)):                                   # prefixes
        add(w.hash_ranges(s, np.minimum(s + k, e)), 2 + i, every)
    for i, k in enumerate((2, 3, 4)):                                # suffixes
        add(w.hash_ranges(np.maximum(e - k, s), e), 4 + i, every)
    grams = np.maximum(n - 2, 1)                                     # byte trigrams
    who = np.repeat(every, grams)
    pos = np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams) + s[who]
    add(w.hash_ranges(pos, np.minimum(pos + 3, e[who])), 7, who)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order], np.searchsorted(owner[order], np.arange(len(at) + 1))


def emissions(weights: np.ndarray, flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.add.reduceat(weights[flat], off[:-1], axis=0) if len(off) > 1 else np.zeros((0, weights.shape[1]), np.float32)


def chains(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of the chains of rows with word offsets ``first``."""
    n = np.diff(first)
    many = -(-n // SEGMENT)
    row = np.repeat(np.arange(len(n)), many)
    k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = first[row] + k * SEGMENT
    return start, np.minimum(SEGMENT, first[row + 1] - start)


def _vocabulary(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct word of every word, buckets of the distinct words, their offsets, word offsets of
    the texts), a slice of the texts at a time."""
    known = np.zeros(0, np.uint64)
    words, counts, flats, sizes = [], [], [], []
    for part in tx.slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
        w = tx.Words(_lowered(tx.column(part, "text")), tx.IS_LETTER)
        h = w.hashes()
        u, at = np.unique(h, return_index=True)
        new = ~np.isin(u, known)
        flat, off = features(w, at[new])
        known = np.concatenate([known, u[new]])
        words.append(h)
        counts.append(np.diff(w.first))
        flats.append(flat)
        sizes.append(np.diff(off))
    cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
    order = np.argsort(known)
    word = order[np.searchsorted(known[order], cat(words, np.uint64))]
    return word, cat(flats, np.int64), np.concatenate([[0], np.cumsum(cat(sizes, np.int64))]), \
        np.concatenate([[0], np.cumsum(cat(counts, np.int64))])


class ChainField:
    """Weights of the field: word features (BUCKETS x K), transitions (K x K), starts (K)."""

    def __init__(self, labels: list[str]):
        k = len(labels)
        self.labels = labels
        self.weights = np.zeros((BUCKETS, k), np.float32)
        self.trans = np.zeros((k, k))
        self.begin = np.zeros(k)

    def marginals(self, emission: np.ndarray, start: np.ndarray, length: np.ndarray, pairs: bool = False):
        """Label marginals of every word (rows of ``emission``); with ``pairs`` also the summed
        transition marginals and the summed start marginals."""
        k, m = len(self.labels), len(start)
        out = np.zeros((len(emission), k))
        if not m:
            return (out, np.zeros((k, k)), np.zeros(k)) if pairs else out
        order = np.argsort(-length, kind="stable")  # longest first: step t works on the first alive[t]
        start, length = start[order], length[order]
        steps = int(length[0])
        alive = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps)]
        e = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
        trans, begin = np.exp(self.trans - self.trans.max()), np.exp(self.begin - self.begin.max())
        alpha = [None] * steps
        a = begin * e[start]
        alpha[0] = a = a / a.sum(axis=1, keepdims=True)
        for t in range(1, steps):
            a = (a[:alive[t]] @ trans) * e[start[:alive[t]] + t]
            alpha[t] = a = a / a.sum(axis=1, keepdims=True)
        beta = np.ones((m, k))
        both = np.zeros((k, k))
        for t in range(steps - 1, -1, -1):
            n = alive[t]
            g = alpha[t] * beta[:n]
            g /= g.sum(axis=1, keepdims=True)
            out[start[:n] + t] = g
            if t:
                right = e[start[:n] + t] * beta[:n]
                if pairs:
                    z = (alpha[t - 1][:n] @ trans * right).sum(axis=1, keepdims=True)
                    both += (alpha[t - 1][:n] / z).T @ right * trans
                b = right @ trans.T
                beta[:n] = b / b.sum(axis=1, keepdims=True)
        return (out, both, out[start].sum(axis=0)) if pairs else out

    def fit(self, texts: pa.Array, labels: np.ndarray, seed: int = 5) -> "ChainField":
        """Adam on the mean log-likelihood of the words' labels (every word has its text's)."""
        word, flat, off, first = _vocabulary(texts)
        if not len(word):
            return self
        start, length = chains(first)
        gold = labels[np.repeat(np.arange(len(first) - 1), np.diff(first))]
        rng, k = np.random.default_rng(seed), len(self.labels)
        params = [self.weights, self.trans, self.begin]
        m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(EPOCHS):
            for pick in np.array_split(rng.permutation(len(start)), max(1, len(start) // BATCH)):
                s, n = start[pick], length[pick]
                who = np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at_ = np.cumsum(n) - n
                used, local = np.unique(word[who], return_inverse=True)
                sizes = off[used + 1] - off[used]
                take = np.repeat(off[used], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                f, fo = flat[take], np.concatenate([[0], np.cumsum(sizes)])
                p, both, begins = self.marginals(emissions(self.weights, f, fo)[local], at_, n, pairs=True)
                diff = p.copy()
                diff[np.arange(len(who)), gold[who]] -= 1
                per_word = np.stack([np.bincount(local, diff[:, j], len(used)) for j in range(k)], axis=1)
                spread = np.repeat(per_word, sizes, axis=0)
                grad = np.stack([np.bincount(f, spread[:, j], BUCKETS) for j in range(k)], axis=1)
                own = np.bincount(gold[s], n - 1, k)
                grads = [grad / len(who), (both - np.diag(own)) / len(who),
                         (begins - np.bincount(gold[s], minlength=k)) / len(who)]
                step += 1
                for x, g, a, b in zip(params, grads, m1, m2):
                    g = g + L2 * x
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    x -= (RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)).astype(x.dtype)
        return self

    def label_words(self, texts: pa.Array) -> tuple[tx.Words, np.ndarray]:
        """(words, marginals) of whole texts."""
        w = tx.Words(_lowered(texts), tx.IS_LETTER)
        if not len(w):
            return w, np.zeros((0, len(self.labels)))
        _, at, word = np.unique(w.hashes(), return_index=True, return_inverse=True)
        e = emissions(self.weights, *features(w, at))[word]
        return w, self.marginals(e, *chains(w.first))


def train(documents: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 5, sample_chars: int = SAMPLE_CHARS) -> ChainField:
    """Fit a field on ``documents`` (doc_id, text, lang), all of whose rows may be learned from.

    Texts up to ``sample_chars`` characters are drawn; of a language that has none, longer ones.
    """
    rows = documents.filter("text IS NOT NULL AND lang IS NOT NULL AND lang <> ''") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    short = F.length("text") <= sample_chars
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(short).alias("short")).collect()  # one row a language
    counts = {r["lang"]: r["short"] or r["n"] for r in found}
    long_only = [r["lang"] for r in found if not r["short"]]
    if not counts:
        return ChainField([])
    each = max(20, sample_docs // len(counts))
    keep = F.coalesce(*[F.when(F.col("lang") == k, F.lit(each / n)) for k, n in sorted(counts.items())])
    drawn = rows.filter(short | F.col("lang").isin(long_only)).filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) < keep * (1 << 30)).toArrow()
    drawn = drawn.take(pc.sort_indices(drawn, [("doc_id", "ascending"), ("text", "ascending")]))  # any plan, same order
    labels = sorted(set(drawn["lang"].to_pylist()))
    text = pc.cast(drawn["text"], pa.large_string()).combine_chunks()
    gold = np.array([labels.index(x) for x in drawn["lang"].to_pylist()], dtype=np.int64)
    return ChainField(labels).fit(text if isinstance(text, pa.Array) else text.chunk(0), gold, seed) if labels else ChainField([])


def _predictor(model):
    def run(batches):
        field = model.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                arr = tx.column(part, "text")
                n, k = part.num_rows, len(field.labels)
                lettered = pc.match_substring_regex(arr.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
                pred, score = np.full(n, -1), np.zeros(n)
                if k:
                    w, p = field.label_words(arr)
                    total = np.stack([np.bincount(w.row, p[:, j], n) for j in range(k)], axis=1)
                    many = np.maximum(np.diff(w.first), 1)
                    pred = np.where(lettered, total.argmax(axis=1), -1)
                    score = np.where(lettered, np.clip(total.max(axis=1) / many, 0, 1), 0.0)
                names = [field.labels[i] if i >= 0 else UNKNOWN for i in pred.tolist()]
                yield pa.RecordBatch.from_arrays([tx.column(part, "row"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                                 names=["row", "lang_pred", "score"])
    return run


def predict(documents: DataFrame, field: ChainField) -> DataFrame:
    """Rows (row, lang_pred, score): the input row as a struct and its language.

    Only ``text`` is looked at.  Defined cases: a null text, or one without a letter, is
    'und' with score 0; without any learned language every row is.  Ties go to the
    alphabetically first language.  Repeated rows get equal answers; an empty table
    gives no rows; further columns may have any name.
    """
    model = documents.sparkSession.sparkContext.broadcast(field)  # BUCKETS x languages floats
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("text").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_predictor(model), schema)


def held_out(folds: int = 5, fold: int = 0):
    """Column: crc32 of doc_id as text, modulo ``folds``, is ``fold`` (a null doc_id: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))
