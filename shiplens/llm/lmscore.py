"""Operator 9 - language-model scoring by masked pseudo-likelihood.

A small window network predicts every token from the tokens on both of its sides:

    hidden = tanh(sum over offsets o of  E[token at t + o] * C[o]  + b)
    p(token) = softmax over classes(hidden) * softmax within the class(hidden)

with the most frequent words in classes of neighbours in frequency.  Their number grows
with the square root of the corpus's tokens, from ``VOCAB`` up.  All other words share id 0,
and each has its own probability: p(id 0) times the probability of its spelling under a
byte-pair model counted over all such words.  A document's pseudo-log-likelihood is the sum
of the log-probabilities of all its tokens, each with the token itself masked.

1. Word counts are taken over all documents (per task, then a shuffle of counts).
2. Every task trains a copy of the network in numpy on all windows of all its documents
   (``TRAIN_RATE`` 1); the copies are averaged by the windows they saw, in a shuffle of
   weight pieces that holds one piece at a time.  ``ROUNDS`` rounds.  The byte pairs of
   the words of id 0 are counted in the same scan and travel as further pieces.
3. One scan scores every token of every document.

What moves (counts, one network a task) grows with the input; the network with its root.
The copies meet once a round, so scores depend on how the input is split into tasks: a copy
that sees few windows makes few steps (on 18,000 tokens 2 and 5 tasks differ by 2 nats a token).
Compare scores of one network only; what the tests hold for any split is the order of texts.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx
from shiplens.session import materialize, release

CLASSES, PER_CLASS = 32, 64
VOCAB = CLASSES * PER_CLASS          # ids of the smallest network; id 0 is any word without an id
DIM, WINDOW = 24, 2
TRAIN_RATE, ROUNDS = 1.0, 1
BATCH, RATE = 4096, 0.1
PIECE = 1 << 13                      # weights of one piece in the shuffle
EDGE = 256                           # stands before and after the bytes of a word
PAIRS = (EDGE + 1) ** 2
FLUSH = 1 << 20                      # distinct words a task keeps before it sends counts on


def _words(arr: pa.Array) -> tx.Words:
    return tx.Words(arr, tx.IS_ALNUM)


# ----------------------------------------------------------------- word counts

def _count_words(batches):
    def out(h, n):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64), pa.int64()), pa.array(n, pa.int64())], names=["word", "n"])

    def merge(hs, ns):
        h, inverse = np.unique(np.concatenate(hs), return_inverse=True)
        return h, np.bincount(inverse, np.concatenate(ns), len(h)).astype(np.int64)
    hs, ns, held = [], [], 0
    for batch in batches:
        for part in tx.slices(batch, "text"):
            h, n = np.unique(_words(tx.column(part, "text")).hashes(), return_counts=True)
            hs.append(h)
            ns.append(n)
            held += len(h)
            if held > 2 * FLUSH:
                h, n = merge(hs, ns)
                if len(h) > FLUSH:
                    yield out(h, n)
                    hs, ns, held = [], [], 0
                else:
                    hs, ns, held = [h], [n], len(h)
    if hs:
        yield out(*merge(hs, ns))


def vocabulary_size(tokens: int) -> int:
    """Ids of a network for so many tokens: a power of two near their square root, VOCAB at least."""
    return max(VOCAB, 1 << round(np.log2(max(tokens, 1)) / 2))


def vocabulary(docs: DataFrame) -> np.ndarray:
    """Hashes of the most frequent words that get an id, most frequent first (ties by hash)."""
    counts = materialize(docs.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    size = vocabulary_size(counts.agg(F.sum("n")).first()[0] or 0)
    top = counts.orderBy(F.desc("n"), "word").limit(size - 1).select("word").toArrow()
    release(counts)
    return top["word"].to_numpy().astype(np.int64).view(np.uint64)


# -------------------------------------------------------------------- spelling

def _pairs(w: tx.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte pairs of the words ``which``, edges included, and the row of each pair."""
    if not len(which):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = (w.end - w.start)[which]
    at = np.arange(int((n + 1).sum())) - np.repeat(np.cumsum(n + 1) - n - 1, n + 1)
    pos = np.repeat(w.start[which], n + 1) + at
    code = _byte(w, pos - 1, at == 0) * (EDGE + 1) + _byte(w, pos, at == np.repeat(n, n + 1))
    return code, np.repeat(w.row[which], n + 1)


def _byte(w: tx.Words, pos: np.ndarray, edge: np.ndarray) -> np.ndarray:
    return np.where(edge, EDGE, w.data[np.clip(pos, 0, len(w.data) - 1)].astype(np.int64))


def spelling_table(pairs: np.ndarray) -> np.ndarray | None:
    """log p(byte | byte before), each count raised by one; None when no word was counted."""
    if not pairs.any():
        return None
    n = pairs.reshape(EDGE + 1, EDGE + 1) + 1.0
    return np.log(n / n.sum(axis=1, keepdims=True)).ravel()


# --------------------------------------------------------------------- network

class WindowNetwork:
    """The network's weights and its forward and backward passes on id arrays."""

    def __init__(self, vocab: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.vocab = np.sort(vocab)
        self.ids = np.argsort(vocab, kind="stable") + 1  # id of each sorted hash: its frequency rank
        self.windows = 0                                 # windows the last round was trained on
        self.spelling = None                             # see spelling_table()
        self.classes, self.per = CLASSES, PER_CLASS
        while self.classes * self.per <= len(vocab):
            if self.classes < self.per:
                self.classes *= 2
            else:
                self.per *= 2
        self.size = self.classes * self.per              # ids 0 .. size - 1; size is 'outside the document'
        small = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        self.p = {"E": small(self.size + 1, DIM), "C": np.ones((2 * WINDOW, DIM), np.float32), "b": np.zeros(DIM, np.float32),
                  "Wc": small(DIM, self.classes), "bc": np.zeros(self.classes, np.float32),
                  "Wt": small(self.classes, DIM, self.per), "bt": np.zeros((self.classes, self.per), np.float32)}

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def tokens(self, w: tx.Words) -> np.ndarray:
        """Ids of a slice's words."""
        h = w.hashes()
        if not len(self.vocab):
            return np.zeros(len(h), np.int64)
        at = np.searchsorted(self.vocab, h)
        at[at == len(self.vocab)] = 0
        return np.where(self.vocab[at] == h, self.ids[at], 0)

    def contexts(self, ids: np.ndarray, w: tx.Words, at: np.ndarray) -> np.ndarray:
        """Neighbour ids of the tokens ``at``, left to right, the token itself left out."""
        row = w.row[at]
        out = np.empty((len(at), 2 * WINDOW), np.int64)
        for j, o in enumerate([*range(-WINDOW, 0), *range(1, WINDOW + 1)]):
            p = at + o
            ok = (p >= w.first[row]) & (p < w.first[row + 1])
            out[:, j] = np.where(ok, ids[np.clip(p, 0, len(ids) - 1)], self.size)
        return out

    def hidden(self, ctx: np.ndarray, rows: list | None = None) -> np.ndarray:
        """Hidden layer of each window; ``rows`` collects the embeddings read, a matrix an offset."""
        p = self.p
        z = np.broadcast_to(p["b"], (len(ctx), DIM)).copy()
        for j in range(2 * WINDOW):
            e = p["E"].take(ctx[:, j], axis=0)
            z += e * p["C"][j]
            if rows is not None:
                rows.append(e)
        return np.tanh(z, out=z)

    def log_prob(self, ctx: np.ndarray, target: np.ndarray) -> np.ndarray:
        p = self.p
        order, cls, item, cut = self._by_class(target)
        h = self.hidden(ctx.take(order, axis=0))
        got = _log_share(h, p["Wc"], p["bc"], cls)
        for c in np.flatnonzero(np.diff(cut)):
            at = slice(cut[c], cut[c + 1])
            got[at] += _log_share(h[at], p["Wt"][c], p["bt"][c], item[at])
        out = np.empty_like(got)
        out[order] = got
        return out

    def _by_class(self, target: np.ndarray):
        """Order by class, then the classes and places in it in that order, and where each class begins."""
        cls = target // self.per
        order = np.argsort(cls.astype(np.uint16) if self.classes < 1 << 16 else cls, kind="stable")
        cls = cls[order]
        return order, cls, target[order] % self.per, np.searchsorted(cls, np.arange(self.classes + 1))

    def step(self, ctx: np.ndarray, target: np.ndarray, seen: dict[str, np.ndarray]) -> None:
        """One Adagrad step on a batch; ``seen`` keeps the squared gradients."""
        p, n = self.p, len(target)
        order, cls, item, cut = self._by_class(target)
        ctx, rows = ctx.take(order, axis=0), []
        h = self.hidden(ctx, rows)
        g = _softmax(h, p["Wc"], p["bc"], n)
        g[np.arange(n), cls] -= 1 / n
        dh = g @ p["Wc"].T
        self._move("Wc", ..., h.T @ g, seen)
        self._move("bc", ..., _column_sums(g), seen)
        met = np.flatnonzero(np.diff(cut))      # only what the batch meets has gradients
        gw, gb = np.empty((len(met), DIM, self.per), h.dtype), np.empty((len(met), self.per), h.dtype)
        for k, c in enumerate(met.tolist()):
            at = slice(cut[c], cut[c + 1])
            part, w = h[at], p["Wt"][c]
            g = _softmax(part, w, p["bt"][c], n)
            g[_PLACES[:len(g)] if len(g) <= len(_PLACES) else np.arange(len(g)), item[at]] -= 1 / n
            dh[at] += g @ w.T
            np.matmul(part.T, g, out=gw[k])
            np.matmul(_ones(len(g), g.dtype), g, out=gb[k])
        whole = ... if len(met) == self.classes else met
        self._move("Wt", whole, gw, seen)
        self._move("bt", whole, gb, seen)
        dz = dh * (1 - h * h)
        token = ctx.T.ravel()
        de = np.concatenate([dz * p["C"][j] for j in range(2 * WINDOW)])
        self._move("b", ..., _column_sums(dz), seen)
        self._move("C", ..., np.stack([_column_sums(dz * e) for e in rows]), seen)
        order = np.argsort(token.astype(np.uint16) if self.size < 1 << 16 else token, kind="stable")
        token = token[order]
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        self._move("E", token[first], np.add.reduceat(de.take(order, axis=0), first, axis=0), seen)

    def _move(self, k: str, at, g: np.ndarray, seen: dict[str, np.ndarray]) -> None:
        """Adagrad: part ``at`` of weights ``k`` against its gradient."""
        square, step = seen[k][at], g * g
        square += step
        if isinstance(at, np.ndarray):       # a copy of chosen rows
            seen[k][at] = square
        np.sqrt(square, out=step)
        step += 1e-6
        g *= RATE
        g /= step
        self.p[k][at] -= g


_ONES = np.ones(1 << 16, np.float32)
_PLACES = np.arange(BATCH)


def _ones(n: int, dtype) -> np.ndarray:
    return _ONES[:n] if n <= len(_ONES) and dtype == np.float32 else np.ones(n, dtype)


def _exps(h: np.ndarray, w: np.ndarray, bias: np.ndarray, at: np.ndarray | None = None):
    """exp of the scores of each row, their sums and the scores at ``at``; rows are moved down only
    where a sum would leave the range of floats."""
    for moved in (False, True):
        x = h @ w
        x += bias
        if moved:
            x -= x.max(axis=1, keepdims=True)
        got = None if at is None else x[np.arange(len(x)), at]
        with np.errstate(over="ignore"):
            np.exp(x, out=x)
            total = x @ _ones(x.shape[1], x.dtype)
        if moved or (total.min(initial=1) > 1e-30 and total.max(initial=1) < 1e30):
            return x, total, got


def _log_share(h: np.ndarray, w: np.ndarray, bias: np.ndarray, at: np.ndarray) -> np.ndarray:
    _, total, got = _exps(h, w, bias, at)
    return got - np.log(total)


def _column_sums(x: np.ndarray) -> np.ndarray:
    return _ones(len(x), x.dtype) @ x


def _softmax(h: np.ndarray, w: np.ndarray, bias: np.ndarray, n: int) -> np.ndarray:
    """Softmax by row, divided by ``n``."""
    x, total, _ = _exps(h, w, bias)
    total *= n
    x /= total[:, None]
    return x


# -------------------------------------------------------------------- training

def _trainer(network, rate: float, seed: int):
    """Train a copy on a seeded share of the task's windows; pieces (piece, windows, values)."""
    def run(batches):
        net = copy.deepcopy(network.value)
        seen = {k: np.full_like(v, 1e-4) for k, v in net.p.items()}
        trained, held, pairs = 0, [], np.zeros(PAIRS)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                w = _words(tx.column(part, "text"))
                ids = net.tokens(w)
                pairs += np.bincount(_pairs(w, np.flatnonzero(ids == 0))[0], minlength=PAIRS)
                # which windows: by the words around and their place in the document, not by the plan
                at = np.arange(len(w))
                if rate < 1:
                    draw = tx.mix64(w.hashes() + (at - w.first[w.row]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
                    at = np.flatnonzero(draw < np.uint64(int(rate * 2 ** 64)))
                held.append((net.contexts(ids, w, at), ids[at]))
                if sum(len(t) for _, t in held) >= BATCH:
                    ctx, target = (np.concatenate(x) for x in zip(*held))
                    whole = len(target) // BATCH * BATCH
                    for s in range(0, whole, BATCH):
                        net.step(ctx[s:s + BATCH], target[s:s + BATCH], seen)
                    trained += whole
                    held = [(ctx[whole:], target[whole:])]
        ctx, target = (np.concatenate(x) for x in zip(*held)) if held else (None, [])
        if len(target):
            net.step(ctx, target, seen)
            trained += len(target)
        if trained:
            flat = np.concatenate([net.flat(), (pairs / trained).astype(np.float32)])  # by windows, as the mean weighs
            cuts = range(0, len(flat), PIECE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cuts)), pa.int32()), pa.array([trained] * len(cuts), pa.int64()),
                 pa.array([flat[s:s + PIECE].tobytes() for s in cuts], pa.binary())], names=["piece", "windows", "weights"])
    return run


def _average(batches):
    """Rows in order of piece -> the mean weights of each piece, by windows."""
    def out(piece, n, total):
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([n], pa.int64()),
                                           pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())],
                                          names=["piece", "windows", "weights"])
    piece, n, total = None, 0, None
    for batch in batches:
        for p, k, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
            v = np.frombuffer(v, np.float32).astype(np.float64) * k
            if p != piece:
                if piece is not None:
                    yield out(piece, n, total)
                piece, n, total = p, k, v
            else:
                n, total = n + k, total + v
    if piece is not None:
        yield out(piece, n, total)


def train(documents: DataFrame, rate: float = TRAIN_RATE, rounds: int = ROUNDS, seed: int = 11) -> WindowNetwork:
    """A network trained on all of ``documents`` (text)."""
    docs = documents.select(F.col("text").cast("string").alias("text"))
    net = WindowNetwork(vocabulary(docs), seed)
    schema = "piece int, windows long, weights binary"
    for r in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(net)  # size * DIM * 2 floats, about
        pieces = docs.mapInArrow(_trainer(shared, rate, seed + r), schema)
        # by windows within a piece too: the sum's order, and so its rounding, does not hang on the plan
        mean = pieces.repartition("piece").sortWithinPartitions("piece", "windows", "weights").mapInArrow(_average, schema)
        rows = sorted(mean.collect(), key=lambda x: x["piece"])  # one network
        if rows:
            flat = np.concatenate([np.frombuffer(x["weights"], np.float32) for x in rows])
            net.load(flat[:-PAIRS])
            net.windows = rows[0]["windows"]
            net.spelling = spelling_table(np.rint(flat[-PAIRS:].astype(np.float64) * net.windows))
        shared.unpersist()
    return net


def _scorer(network):
    def run(batches):
        net = network.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                w = _words(tx.column(part, "text"))
                ids, n = net.tokens(w), part.num_rows
                total = np.zeros(n)
                for s in range(0, len(w), 1 << 15):
                    at = np.arange(s, min(s + (1 << 15), len(w)))
                    total += np.bincount(w.row[at], net.log_prob(net.contexts(ids, w, at), ids[at]), n)
                if net.spelling is not None:
                    code, row = _pairs(w, np.flatnonzero(ids == 0))
                    total += np.bincount(row, net.spelling[code], n)
                yield pa.RecordBatch.from_arrays(
                    [tx.column(part, "row"), pa.array(np.diff(w.first), pa.int64()),
                     pa.array(np.bincount(w.row[ids == 0], minlength=n)[:n], pa.int64()), pa.array(total, pa.float64())],
                    names=["row", "n_tokens", "n_unknown", "log_likelihood"])
    return run


def score(documents: DataFrame, network: WindowNetwork) -> DataFrame:
    """Rows (row, n_tokens, n_unknown, log_likelihood) for every row of ``documents``.

    ``log_likelihood`` sums the natural log-probabilities of all tokens of the whole text;
    ``n_unknown`` counts the tokens whose probability is that of their spelling within id 0
    (within a network whose corpus had no such word, id 0 is one event, of share 1).
    Defined cases: a null, empty or wordless text has 0 tokens and likelihood 0; repeated
    rows score alike; an empty table gives no rows; further columns may have any name.
    """
    shared = documents.sparkSession.sparkContext.broadcast(network)
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("text").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_unknown", T.LongType()), T.StructField("log_likelihood", T.DoubleType())])
    return rows.mapInArrow(_scorer(shared), schema)
