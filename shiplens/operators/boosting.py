"""Gradient-boosted trees that can stop: absolute and pinball loss, early stopping without refitting.

Spark ML's boosting has neither a quantile loss nor a way to go on from a fitted ensemble, so the loop
is written here.  Every feature is cut into at most ``BINS`` bins once.  A row's bins, labels and
predictions lie together in persisted partitions, in blocks of up to ``BLOCK`` rows.  A round derives from them what its
passes read (bins of the training rows, signs of the gradients, cells of the residuals: a third of the bytes); it is
one pass per tree level that sums histograms (bin -> gradient, rows) over all partitions, and one that sums the
residuals of each leaf, from whose quantiles the leaf values come.  The pass of the first level
also gets the validation error of the trees so far, so a head stops ``patience`` rounds after its best
round and keeps the trees up to it.  All heads (targets, quantiles) of a call share every pass.

Only histograms reach the driver: heads x nodes x features x bins, whatever the number of
rows.  Predictions are kept every ``KEPT`` rounds and checkpointed every ``CHECKPOINT``, so a lost executor costs at most
that many rounds of one partition.  RDDs are used because each pass is per-partition array work
of a few milliseconds, less than planning a DataFrame job takes.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.session import checkpoint_dir

BINS = 64
PART_ROWS = 16_000       # rows a partition, at least: smaller ones cost more in tasks than they save
MOST_ROWS = 2_000_000    # rows a partition, at most
BLOCK = 1 << 17          # rows that are counted together, at most
SLICE = 1 << 16          # rows that are placed in a tree together, at most
KEPT = 5                 # rounds after which a partition is kept with its new predictions
CHECKPOINT = 50          # rounds after which they are also written; a multiple of KEPT
DOWN, UP = float(1 << 18), float(1 << 36)      # rows below and above their predictions in a sum of at most BLOCK rows
FEW_CUTS = 16            # cuts up to which comparing with each takes less than a search
GRID = 512               # residual cells on either side of zero
STORED = StorageLevel.MEMORY_AND_DISK_DESER      # chunks are bytes to the JVM: serialising them again only copies them
LOG_RANGE = np.arcsinh(1e4)
TREES = "round int, names array<string>, feature array<int>, cut array<double>, leaf array<double>"


@dataclass
class BoostedTrees:
    """A fitted ensemble: trees are heaps of (feature, cut), rows with a value above the cut go right."""

    names: list
    base: float
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    leaf: list = field(default_factory=list)
    errors: list = field(default_factory=list)      # validation error after 0, 1, 2 ... trees

    def __len__(self) -> int:
        return len(self.leaf)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of features in the order of ``names``; a missing value goes left."""
        x = np.where(np.isnan(x), -np.inf, x)
        n = len(x)
        flat, base, out = x.ravel(), np.arange(n) * x.shape[1], np.full(n, self.base)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(n, np.int64)
            for _ in range(len(leaf).bit_length() - 1):
                node = 2 * node + 1 + (flat[base + feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out

    def column(self):
        """The prediction as a column (vectorised; works on streams)."""
        model = self

        @F.pandas_udf("double")
        def predicted(*cols: pd.Series) -> pd.Series:
            return pd.Series(model.predict(np.stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in cols], axis=1)))
        return predicted(*[F.col(c).cast("double") for c in self.names])

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row a tree; the row of round -1 holds the names and the base."""
        rows = [(-1, list(self.names), [], [], [float(self.base)])]
        rows += [(i, None, f.tolist(), c.tolist(), v.tolist()) for i, (f, c, v) in enumerate(zip(self.feature, self.cut, self.leaf))]
        return spark.createDataFrame(rows, TREES)

    @staticmethod
    def from_frame(df: DataFrame) -> "BoostedTrees":
        rows = sorted(df.collect(), key=lambda r: r["round"])      # the model itself: a few thousand rows
        return BoostedTrees(list(rows[0]["names"]), rows[0]["leaf"][0], [np.array(r["feature"], np.int64) for r in rows[1:]],
                            [np.array(r["cut"], float) for r in rows[1:]], [np.array(r["leaf"], float) for r in rows[1:]])


@dataclass
class Head:
    """What one ensemble predicts: ``quantile`` None is the absolute loss; ``rounds`` fixes their number."""

    name: str
    label: str
    features: list
    quantile: float | None = None
    rounds: int | None = None


def _binned(v: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The number of cuts below each value; none below a missing one."""
    if len(cuts) > FEW_CUTS:
        return np.searchsorted(cuts, np.where(np.isnan(v), -np.inf, v), side="left").astype(np.uint8)
    out = np.zeros(len(v), np.uint8)
    for c in cuts.tolist():
        out += v > c
    return out


def _chunks(names, cuts, labels, start):
    """Arrow batches of training rows -> pickled chunks; what has a line a row in the table lies side by side in them."""
    def run(batches):
        for whole in batches:
            for b in (whole.slice(at, BLOCK) for at in range(0, whole.num_rows, BLOCK)):
                col = lambda c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                bins = np.stack([_binned(col(c).astype(float), cuts[j]) for j, c in enumerate(names)])
                chunk = {"bins": bins, "valid": col("is_valid").astype(bool), "key": col("_key").view(np.uint64),
                         "y": np.stack([col(y).astype(float) for y in labels]),
                         "pred": np.repeat(np.asarray(start, float)[:, None], b.num_rows, axis=1)}
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(chunk)], pa.binary())], names=["chunk"])
    return run


def _blocks(rows):
    """Rows (chunk,) -> chunks joined up to ``BLOCK`` rows: a pass has a cost for each of them."""
    held, n = [], 0
    for c in (pickle.loads(r[0]) for r in rows):
        if held and n + len(c["valid"]) > BLOCK:
            yield _joined(held)
            held, n = [], 0
        held.append(c)
        n += len(c["valid"])
    if held:
        yield _joined(held)


def _joined(chunks):
    return {k: np.concatenate([c[k] for c in chunks], axis=-1) for k in chunks[0]}


def _arranged(c, bag: int, limit):
    """The chunk with the training rows that ``bag`` draws first, then the others, then the rows to judge by (each in the
    order they had), so that a pass takes slices of it."""
    valid = c["valid"] if "valid" in c else np.arange(len(c["key"])) >= c["train"]
    inside = (_mixed(c["key"] ^ _mixed(np.array([bag], np.uint64))) >> np.uint64(11)) < limit
    drawn = np.flatnonzero(~valid & inside)
    rows = np.concatenate([drawn, np.flatnonzero(~valid & ~inside), np.flatnonzero(valid)])
    return {"bag": bag, "drawn": len(drawn), "train": len(valid) - int(valid.sum()), "key": c["key"].take(rows),
            **{k: [x.take(rows) for x in c[k]] for k in ("bins", "y", "pred")}}


def _pieces(c):
    """A chunk as its arrays one by one and the rest: between the JVM and Python pieces of up to 1 MB take half the time
    of one of many."""
    for k, x in c.items():
        if isinstance(x, list):
            yield from ((k, part) for part in x)
    yield None, {k: x for k, x in c.items() if not isinstance(x, list)}


def _whole(pieces):
    """The chunks of ``_pieces``."""
    c = {}
    for k, x in pieces:
        if k is None:
            yield {**c, **x}
            c = {}
        else:
            c.setdefault(k, []).append(x)


def _each(work):
    """``work(chunk)``, a chunk, for what lies in an RDD in pieces."""
    def part(pieces):
        for c in _whole(pieces):
            yield from _pieces(work(c))
    return part


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _node(bins, tree, depth: int) -> np.ndarray:
    """Place of each row within its level, after ``depth`` splits of a tree of (feature, bin) heaps; ``bins`` by feature.

    Every split is asked of all rows, and a place is put together from the lowest split up: whole arrays of bytes take
    less than looking up each row's own splits.  A split at 255 sends all rows left.
    """
    n, bit = len(bins[0]), [np.uint8(1 << d) for d in range(depth)]
    feature, cut = tree[0].tolist(), [None if c == 255 else np.uint8(c) for c in tree[1].tolist()]
    out = np.zeros(n, np.uint8)

    def placed(node, below, into):
        """``into``: the place of each row of the slice below ``node``, which has ``below`` further levels."""
        split = cut[node]
        if below:
            placed(2 * node + 1, below - 1, into)
            if split is not None:
                other, right = others[below], rights[below]
                placed(2 * node + 2, below - 1, other)
                np.greater(part[feature[node]], split, out=right.view(bool))
                np.bitwise_xor(other, into, out=other)
                np.bitwise_or(other, bit[below], out=other)
                np.multiply(other, right, out=other)
                np.bitwise_xor(into, other, out=into)
        elif split is None:
            into.fill(0)
        else:
            np.greater(part[feature[node]], split, out=into.view(bool))
    for at in range(0, n if depth else 0, SLICE):
        part, into = [b[at:at + SLICE] for b in bins], out[at:at + SLICE]
        others, rights = (list(np.empty((depth, len(into)), np.uint8)) for _ in range(2))
        placed(0, depth - 1, into)
    return out


def _histograms(bins, picks, weight: np.ndarray, some=None, group=None, groups: int = 1) -> np.ndarray:
    """Sums of ``weight`` as [group, feature, bin], over ``some`` rows in their ``group`` (all rows in one when None).

    Two features are counted at once, by the pair of their bins, as long as the rows are more than the pairs.
    """
    out = np.empty((groups, len(picks), BINS))
    if some is not None:
        weight = weight.take(some)
        group = group.take(some).astype(np.int64)
    paired = len(picks) - len(picks) % 2 if 2 * len(weight) > groups * BINS ** 2 else 0
    take = (lambda x: x) if some is None else (lambda x: x.take(some, mode="clip"))
    first = None if some is None else group * BINS ** 2
    for j in range(0, paired, 2):
        pair = bins[picks[j]].astype(np.uint16)
        pair *= np.uint16(BINS)
        pair += bins[picks[j + 1]]
        pair = take(pair)
        found = np.bincount(pair if first is None else first + pair, weight, groups * BINS ** 2).reshape(groups, BINS, BINS)
        out[:, j], out[:, j + 1] = found.sum(axis=2), found.sum(axis=1)
    first = None if some is None else group * BINS
    for j in range(paired, len(picks)):
        cell = take(bins[picks[j]])
        out[:, j] = np.bincount(cell if first is None else first + cell, weight, groups * BINS).reshape(groups, BINS)
    return out


def _summed(rdd, work, depth):
    """``work(chunk)`` (an array) summed over all rows."""
    def part(pieces):
        total = None
        for c in _whole(pieces):
            x = work(c)
            total = x if total is None else total + x
        return [] if total is None else [total]
    return rdd.mapPartitions(part).treeReduce(np.add, depth)


WEIGHT = np.array([1 + DOWN, 1.0, 1 + UP])     # of a row below, at and above its prediction


def _unpacked(sums: np.ndarray, quantile) -> list[np.ndarray]:
    """Gradients and rows from sums of ``WEIGHT``, which are exact."""
    up = np.floor(sums / UP)
    sums = sums - up * UP
    down = np.floor(sums / DOWN)
    return [up - down if quantile is None else quantile * up + (quantile - 1.0) * down, sums - down * DOWN]


def _loss(e, quantile):
    return np.abs(e) if quantile is None else np.maximum(quantile * e, (quantile - 1) * e)


def _moved(c, moves, depth):
    """The chunk with the predictions of further trees: pairs of (trees, leaf values), each by head."""
    pred = [p.copy() for p in c["pred"]]
    for trees, values in moves:
        for i in values:
            pred[i] += values[i].take(_node(c["bins"], trees[i], depth))
    return dict(c, pred=pred)


def _split(hist: np.ndarray, min_rows: int):
    """Best (feature, bin) of each node, and whether it has one: hist is [node, feature, bin, 2]."""
    total = np.cumsum(hist, axis=2)
    g, n = total[..., 0], total[..., 1]
    all_g, all_n = g[:, :, -1:], n[:, :, -1:]
    ok = (n >= min_rows) & (all_n - n >= min_rows)
    gain = np.where(ok, g ** 2 / np.maximum(n, 1) + (all_g - g) ** 2 / np.maximum(all_n - n, 1) - all_g ** 2 / np.maximum(all_n, 1), -1.0)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    return best // hist.shape[2], best % hist.shape[2], flat[np.arange(len(flat)), best] > 1e-9


def _partitions(rows: int, cores: int) -> int:
    """One partition a core, or as many times that as keep them at ``MOST_ROWS``; fewer where rows are few.  A pass is short,
    so further tasks cost more than they balance."""
    return max(1, min(-(-rows // PART_ROWS), cores * -(-rows // (cores * MOST_ROWS))))


def boost(ft: DataFrame, heads: list[Head], step: float = 0.15, depth: int = 6, min_rows: int = 100, max_rounds: int = 5000,
          patience: int = 150, feature_share: float = 0.8, row_share: float = 0.8, bag_every: int = 5, seed: int = 42) -> list[BoostedTrees]:
    """Fit one ensemble per head on the rows of ``ft`` whose ``is_valid`` is false.

    A head without fixed ``rounds`` stops when its error on the ``is_valid`` rows has not improved for ``patience``
    rounds, at ``max_rounds`` at the latest, and keeps its best prefix; without any valid row it has
    ``patience`` rounds.  Rows with a null label are left out; a null feature is less than any cut.
    """
    spark = ft.sparkSession
    sc = spark.sparkContext
    checkpoint_dir(spark)
    names = list(dict.fromkeys(c for h in heads for c in h.features))
    distinct = list(dict.fromkeys(h.label for h in heads))
    labels, of = [f"_y{i}" for i in range(len(distinct))], [distinct.index(h.label) for h in heads]
    x = ft.where(" AND ".join(f"`{h.label}` IS NOT NULL" for h in heads)).select(
        *[F.col(c).cast("double").alias(c) for c in names], *[F.col(c).cast("double").alias(y) for c, y in zip(distinct, labels)],
        "is_valid", F.xxhash64(*names, *[h.label for h in heads]).alias("_key"))
    train = x.where("NOT is_valid")
    # the heads of a further call on the same table often have the features and labels of one before
    known, asked = ft.__dict__.setdefault("_shiplens_cuts", {}), (*names, None, *distinct)
    if asked not in known:
        known[asked] = [np.unique(c) for c in train.approxQuantile(names, [i / BINS for i in range(1, BINS)], 0.001)]
    cuts = known[asked]
    level = [0.5 if h.quantile is None else h.quantile for h in heads]
    levels = sorted(set(level))
    starts = train.approxQuantile(labels, levels, 0.001)
    models = [BoostedTrees(list(h.features), starts[j][levels.index(q)] if starts[j] else 0.0) for h, j, q in zip(heads, of, level)]
    if not any(len(c) for c in cuts) and not any(starts):
        return models        # no training row
    spread = train.agg(*[F.greatest(F.max(y) - F.min(y), F.lit(1e-9)).alias(y) for y in labels], F.count("*").alias("n")).first()
    scale = np.array([spread[labels[j]] for j in of], float)
    index = [np.array([names.index(c) for c in h.features]) for h in heads]
    have, parts = x.rdd.getNumPartitions(), _partitions(spread["n"], sc.defaultParallelism)
    if have > parts:
        x = x.coalesce(parts)
    elif have < min(parts, sc.defaultParallelism):
        x = x.repartition(min(parts, sc.defaultParallelism))
    bag_limit = np.uint64(int(row_share * (2 ** 53)))
    rdd = x.mapInArrow(_chunks(names, cuts, labels, [m.base for m in models]), "chunk binary").rdd.mapPartitions(_blocks) \
        .mapPartitions(lambda chunks: (p for c in chunks for p in _pieces(_arranged(c, seed << 32, bag_limit)))).persist(STORED)
    tree_depth = 1 if rdd.getNumPartitions() <= 64 else 2
    losses = [h.quantile for h in heads]
    active = [i for i, h in enumerate(heads) if h.rounds != 0]
    n_nodes, rounds = 2 ** depth - 1, 0
    previous, moves = None, []
    while active:
        rng = np.random.default_rng([seed, rounds])
        bag = (seed << 32) + rounds // bag_every
        picks = {i: np.sort(rng.permutation(index[i])[:max(1, round(feature_share * len(index[i])))]) for i in active}
        trees = {i: (np.zeros(n_nodes, np.int64), np.full(n_nodes, 255, np.int64)) for i in active}

        def counted(c, bag=bag, moves=tuple(moves), active=tuple(active)):
            """What the passes of this round read of a chunk: bins of the training rows, those drawn first, and of each head
            the gradients' signs, the cells of the residuals and the validation error."""
            if c["bag"] != bag:
                c = _arranged(c, bag, bag_limit)
            pred, drawn, train = _moved(c, moves, depth)["pred"], c["drawn"], c["train"]
            sign, cell, errors = [None] * len(heads), [None] * len(heads), [len(c["key"]) - train]
            for i in active:
                e = c["y"][of[i]] - pred[i]
                sign[i] = np.sign(e[:drawn]).astype(np.int8)
                r = e[:train] / scale[i]
                cell[i] = np.clip(np.rint(np.arcsinh(r * 1e4) / LOG_RANGE * GRID), -GRID, GRID).astype(np.int16) + GRID
                errors.append(_loss(e[train:], losses[i]).sum())
            return {"bins": [b[:train] for b in c["bins"]], "drawn": drawn, "sign": sign, "cell": cell, "errors": np.array(errors, float)}
        now = rdd.mapPartitions(_each(counted)).persist(STORED)

        # below the first level only the smaller child of each node is counted; its sibling is the rest
        hist, side = {}, {i: np.zeros(1, np.int64) for i in active}
        for d in range(depth):
            def level(c, d=d, trees=trees, picks=picks, side=side, active=tuple(active)):
                bins, out = [b[:c["drawn"]] for b in c["bins"]], []
                for i in active:
                    weight, rows = WEIGHT.take(c["sign"][i] + 1), ()
                    if d:
                        node = _node(bins, trees[i], d)
                        counts = np.zeros(2 ** d, bool)     # by place: whether it is the smaller child
                        counts[2 * np.arange(len(side[i])) + side[i]] = True
                        rows = np.flatnonzero(counts.take(node)), node >> 1, len(side[i])
                    out += _unpacked(_histograms(bins, picks[i], weight, *rows).ravel(), losses[i])
                return np.concatenate(out if d else [*out, c["errors"]])
            total = _summed(now, level, tree_depth)
            if d == 0:
                if previous is not None:
                    previous.unpersist()
                    previous = None
                judged, errors = total[-1 - len(active)], total[-len(active):]
                stopping = set()
                for i, e in zip(active, errors):
                    models[i].errors.append(float(e / max(judged, 1)))
                    done = len(models[i])
                    best = int(np.argmin(models[i].errors))
                    limit = heads[i].rounds if heads[i].rounds is not None else (max_rounds if judged else patience)
                    if done >= limit or (heads[i].rounds is None and judged and done - best >= patience):
                        stopping.add(i)
            at = 0
            for i in active:
                k, nodes = len(picks[i]), len(side[i])
                size = nodes * k * BINS
                found = np.stack([total[at:at + size], total[at + size:at + 2 * size]], axis=-1).reshape(nodes, k, BINS, 2)
                at += 2 * size
                if d:
                    pair = np.stack([found, hist[i] - found], axis=1)
                    pair[side[i] == 1] = pair[side[i] == 1][:, ::-1]
                    found = pair.reshape(2 * nodes, k, BINS, 2)
                f, b, some = _split(found, min_rows)
                heap = slice(2 ** d - 1, 2 ** (d + 1) - 1)
                trees[i][0][heap], trees[i][1][heap] = np.where(some, picks[i][f], 0), np.where(some, b, 255)
                left = np.cumsum(found[np.arange(len(f)), f, :, 1], axis=1)
                left = np.where(some, left[np.arange(len(f)), b], left[:, -1])
                hist[i], side[i] = found, (2 * left > found[:, 0, :, 1].sum(axis=1)).astype(np.int64)
            if d == 0 and stopping:
                active = [i for i in active if i not in stopping]
                if not active:
                    break
        if not active:
            now.unpersist()
            break

        def leaves(c, trees=trees, active=tuple(active)):
            size, out = 2 ** depth * (2 * GRID + 1), []
            for i in active:
                node = _node(c["bins"], trees[i], depth).astype(np.int64)
                out.append(np.bincount(node * (2 * GRID + 1) + c["cell"][i], minlength=size))
            return np.concatenate(out)
        total = _summed(now, leaves, tree_depth).reshape(len(active), 2 ** depth, 2 * GRID + 1)
        now.unpersist()
        middle = np.sinh(np.arange(-GRID, GRID + 1) / GRID * LOG_RANGE) / 1e4
        values = {}
        for i, counts in zip(active, total):
            upto = np.cumsum(counts, axis=1)
            q = 0.5 if losses[i] is None else losses[i]
            cell = (upto < q * upto[:, -1:]).sum(axis=1)
            values[i] = np.where(upto[:, -1] > 0, middle[np.minimum(cell, 2 * GRID)], 0.0) * scale[i] * step
            m = models[i]
            own = {int(c): j for j, c in enumerate(index[i])}
            m.feature.append(np.array([own.get(int(f), 0) for f in trees[i][0]], np.int64))
            m.cut.append(np.array([cuts[f][b] if b < len(cuts[f]) else np.inf for f, b in zip(*trees[i])]))
            m.leaf.append(values[i])

        moves.append((trees, values))
        rounds += 1
        if rounds % KEPT == 0:
            previous, rdd = rdd, rdd.mapPartitions(_each(lambda c, moves=tuple(moves), bag=(seed << 32) + rounds // bag_every: _arranged(
                _moved(c, moves, depth), bag, bag_limit))).persist(STORED)
            moves = []
        if rounds % CHECKPOINT == 0:
            rdd.checkpoint()
    rdd.unpersist()
    if previous is not None:
        previous.unpersist()
    for h, m in zip(heads, models):
        keep = len(m) if h.rounds is not None or not any(m.errors) else int(np.argmin(m.errors))
        m.feature, m.cut, m.leaf = m.feature[:keep], m.cut[:keep], m.leaf[:keep]
    return models
