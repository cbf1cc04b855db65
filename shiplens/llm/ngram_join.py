"""Operator 1 - n-gram Jaccard join with signature trees.

Exact self-join of word-shingle sets at a Jaccard threshold, returned as one row
per document with the smallest ``doc_id`` that links lead to.

1. *Scan.*  Every whole text becomes its set of 64-bit shingle hashes.  Equal sets
   (exact copies) collapse to one class, so copies never meet each other again.
2. *Blocks.*  Two sets over the threshold share a token among the first
   ``n - ceil(t * n) + 1`` of any fixed token order.  The order used here puts
   frequently seen tokens last (found by a fixed-size count table over all
   documents); it only steers cost, every order gives the same links.  Of the
   sets that share such a token the least is the *lead*; all sets that share a
   lead make its block.  Blocks of more than ``CHUNK`` sets are dealt into chunks,
   each with the lead.
3. *Signature trees.*  In a chunk the sets, in order of size, are leaves of a tree
   whose nodes hold OR-combined token bitmaps and size ranges.  A dual traversal
   from the root against itself drops node pairs whose sizes are too far apart or
   whose largest possible overlap, popcount(OR_x & OR_y) plus the tokens that share a
   bit, is below what the threshold needs.  The bitmaps (1 to 2 bits a token) are all
   that moves to the chunk.  Pairs that survive the leaves form groups.
4. *Exact trees.*  Only sets of such groups are fetched in full, once each.  A group is
   dealt into chunks like a block; its trees have one bit per token that two sets of the
   chunk hold, so a leaf pair's count is its exact overlap and decides the threshold.
5. Links become components.  In steps 3 and 4 alike, a block of several chunks whose sets
   are not all in one component yet gets its remaining chunk pairs (of compatible sizes)
   joined too.

Nothing is emitted per pair of a group: a chunk yields a spanning forest of its
links.  Sets are compared by 64-bit shingle hashes; classes by 128-bit digests.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm import textops as tx
from shiplens.llm.graph import components
from shiplens.session import materialize, release

CHUNK = 256            # sets in one signature tree
CHUNK_TOKENS = 1 << 21  # tokens in one signature tree, about (one set at least)
FANOUT = 8             # children of a tree node
CELLS = 1 << 22        # cells of the count table that finds frequent tokens
SMALL = 200_000        # rows of a broadcast list of documents (about 64 bytes each)
HOT = 64               # a token whose cell is seen this often is ordered last


def shingle_sets(arr: pa.Array, k: int):
    """Per row of a text array: its sorted distinct k-word shingle hashes (uint64).

    A row of 1 to k-1 words has its whole word sequence as the only shingle; a row
    without words an empty set.
    """
    w = tx.Words(arr)
    h = w.hashes()
    grams = tx.gram_hashes(h, k)
    for i in range(len(arr)):
        a, b = int(w.first[i]), int(w.first[i + 1])
        if b - a >= k:
            s = np.sort(grams[a:b - k + 1])
            keep = np.empty(len(s), dtype=bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif b > a:
            yield tx.gram_hashes(h[a:b], b - a)
        else:
            yield np.zeros(0, dtype=np.uint64)


def digest(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def bitmap(s: np.ndarray) -> np.ndarray:
    """Hashed token bitmap of a set, 1 to 2 bits a token (a power of two, 64 at least).

    At one bit a token unrelated sets of n tokens still differ in about 0.23 n bits.
    """
    width = max(64, 1 << (len(s) - 1).bit_length())
    out = np.zeros(width >> 6, dtype=np.uint64)
    at = ((s >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64)
    np.bitwise_or.at(out, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return out


def _scanner(k: int):
    """doc rows (doc_id, n, hi, lo) and rows (cell, seen) of the frequent cells of the task."""
    def run(batches):
        cells = np.zeros(CELLS, dtype=np.int32)
        known, total = set(), 0
        for batch in batches:
            for part in tx.slices(batch, "text"):
                n, hi, lo = [], [], []
                for s in shingle_sets(tx.column(part, "text"), k):
                    n.append(len(s))
                    a, b = digest(s) if len(s) else (None, None)
                    hi.append(a)
                    lo.append(b)
                    if len(s) and (a, b) not in known:  # copies count once in a task
                        known.add((a, b))
                        np.add.at(cells, (s & np.uint64(CELLS - 1)).astype(np.int64), 1)
                        total += len(s)
                m = len(n)
                yield pa.RecordBatch.from_arrays(
                    [tx.column(part, "doc_id"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()),
                     pa.array(lo, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64())],
                    names=["doc_id", "n", "hi", "lo", "cell", "seen"])
        at = np.flatnonzero(cells >= max(8, 8 + 4 * total / CELLS))  # far beyond what chance gives
        if len(at):
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64())] * 4 + [pa.array(at, pa.int32()), pa.array(cells[at], pa.int64())],
                names=["doc_id", "n", "hi", "lo", "cell", "seen"])
    return run


def _hot_cells(scan: DataFrame) -> np.ndarray:
    """Sorted frequent cells.  At most CELLS / 64 rows of 64-cell words reach the driver."""
    rows = (scan.filter("cell IS NOT NULL").groupBy("cell").agg(F.sum("seen").alias("seen"))
            .filter(F.col("seen") >= HOT)
            .select(F.shiftright("cell", 6).alias("w"),
                    F.expr("shiftleft(1L, cell & 63)").alias("bit"))
            .groupBy("w").agg(F.bit_or("bit").alias("bits")).collect())
    hot = np.zeros(CELLS // 64, dtype=np.uint64)
    for r in rows:
        hot[r["w"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    return hot


def _prefixer(k: int, num: int, den: int, hot):
    def run(batches):
        bits = hot.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                ids = tx.column(part, "doc_id")
                rows, hi, lo, pre, maps = [], [], [], [], []
                for i, s in enumerate(shingle_sets(tx.column(part, "text"), k)):
                    if not len(s):
                        continue
                    cell = s & np.uint64(CELLS - 1)
                    late = (bits[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1)
                    p = len(s) - -(-num * len(s) // den) + 1
                    cold = s[late == 0]
                    t = cold[:p] if len(cold) >= p else np.concatenate([cold, s[late == 1][:p - len(cold)]])
                    a, b = digest(s)
                    rows.append(i)
                    hi.append(a)
                    lo.append(b)
                    pre.append(t.view(np.int64))
                    maps.append(bitmap(s).tobytes())
                counts = np.array([len(x) for x in pre], dtype=np.int64)
                flat = np.concatenate(pre) if pre else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                     tx.list_array(flat, counts, pa.int64()), pa.array(maps, pa.binary())],
                    names=["doc_id", "hi", "lo", "prefix", "bits"])
    return run


def _setter(k: int):
    """(unit, node, tokens) of the rows whose text really is the class's (a doc_id may repeat)."""
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                hi, lo = tx.column(part, "hi").to_pylist(), tx.column(part, "lo").to_pylist()
                rows, out = [], []
                for i, s in enumerate(shingle_sets(tx.column(part, "text"), k)):
                    if len(s) and digest(s) == (hi[i], lo[i]):
                        rows.append(i)
                        out.append(s.view(np.int64))
                flat = np.concatenate(out) if out else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [tx.column(part, "unit").take(pa.array(rows, pa.int64())), tx.column(part, "node").take(pa.array(rows, pa.int64())),
                     tx.list_array(flat, np.array([len(x) for x in out], dtype=np.int64), pa.int64())],
                    names=["unit", "node", "tokens"])
    return run


# --------------------------------------------------------------- signature tree

class SignatureTree:
    """Sets as leaves in order of size; inner nodes hold OR bitmaps and size ranges.

    ``maps`` are the leaves' bitmaps (rows of uint64), ``sizes`` their set sizes.  Where
    several tokens of a set may share a bit, a leaf's spare is its size less its bits; a
    node keeps the largest.  Overlap(A, B) <= popcount(or_x & or_y) + min(spare_x, spare_y).
    """

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, fanout: int = FANOUT):
        self.order = np.argsort(sizes, kind="stable")
        maps, low = maps[self.order], sizes[self.order]
        high, spare = low, low - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.exact = False
        self.fanout, self.levels = fanout, [(maps, low, high, spare)]
        while len(maps) > 1:
            cut = np.arange(0, len(maps), fanout)
            maps = np.bitwise_or.reduceat(maps, cut, axis=0)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            spare = np.maximum.reduceat(spare, cut)
            self.levels.append((maps, low, high, spare))

    @classmethod
    def of_sets(cls, sets: list[np.ndarray], fanout: int = FANOUT) -> "SignatureTree":
        """Exact bitmaps: one bit per token that two of the sets hold (others are in no overlap)."""
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        row = np.repeat(np.arange(len(sets)), sizes)
        _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count >= 2
        bit = np.cumsum(shared) - 1
        keep = shared[inverse]
        at, who = bit[inverse[keep]], row[keep]
        maps = np.zeros((len(sets), max(1, -(-int(shared.sum()) // 64))), dtype=np.uint64)
        np.bitwise_or.at(maps, (who, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
        tree = cls(maps, sizes, fanout)
        tree.exact = True
        tree.levels = [(m, a, b, np.zeros_like(c)) for m, a, b, c in tree.levels]
        return tree

    @staticmethod
    def _count(maps, x, y, how):
        out = np.empty(len(x), dtype=np.int64)
        step = max(1, (1 << 20) // maps.shape[1])
        for i in range(0, len(x), step):
            out[i:i + step] = np.bitwise_count(how(maps[x[i:i + step]], maps[y[i:i + step]])).sum(axis=1, dtype=np.int64)
        return out

    def pairs(self, num: int, den: int) -> np.ndarray:
        """Pairs (positions in the input) that may link, by dual traversal; with exact
        bitmaps those with den * overlap >= num * union."""
        x = y = np.zeros(1, dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            maps, low, high, spare = self.levels[level]
            if level < len(self.levels) - 1:  # children of the pairs that are left
                kids = np.arange(self.fanout)
                cx = (x[:, None] * self.fanout + np.repeat(kids, self.fanout)).ravel()
                cy = (y[:, None] * self.fanout + np.tile(kids, self.fanout)).ravel()
                ok = (cx < len(maps)) & (cy < len(maps)) & (cx <= cy if level else cx < cy)
                x, y = cx[ok], cy[ok]
            elif level == 0:
                return np.zeros((0, 2), dtype=np.int64)
            # leaves are in order of size, so y never holds smaller sets than x
            ok = den * high[x] >= num * low[y]
            x, y = x[ok], y[ok]
            shared = self._count(maps, x, y, np.bitwise_and) + np.minimum(spare[x], spare[y])
            if not level and not self.exact:  # a bit of A that B lacks is a token of A that B lacks
                shared = np.minimum(shared, low[x] - self._count(maps, x, y, lambda a, b: a & ~b))
                shared = np.minimum(shared, low[y] - self._count(maps, x, y, lambda a, b: b & ~a))
            # den * o >= num * (a + b - o), least for the smallest sets of both nodes
            ok = (num + den) * shared >= num * (low[x] + low[y])
            x, y = x[ok], y[ok]
        return np.stack([self.order[x], self.order[y]], axis=1)


def fold(m: np.ndarray, words: int) -> np.ndarray:
    """A bitmap OR-folded to ``words`` uint64 words (both powers of two)."""
    return np.bitwise_or.reduce(m.reshape(-1, words), axis=0)


def likely(sizes: np.ndarray, maps: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Pairs (positions) of sets that may link.  Bitmaps are compared by width: one tree for
    every width, of its sets and the wider ones in reach folded to it."""
    width = np.array([len(m) for m in maps])
    out = [np.zeros((0, 2), dtype=np.int64)]
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        # wider sets that can be partners of these
        more = np.flatnonzero((width > w) & (num * sizes <= den * sizes[own].max()))
        at = np.concatenate([own, more])
        if len(at) < 2:
            continue
        tree = SignatureTree(np.stack([fold(maps[i], w) for i in at.tolist()]), sizes[at])
        pairs = tree.pairs(num, den)
        out.append(at[pairs[(pairs < len(own)).any(axis=1)]])
    return np.concatenate(out)


def forest(m: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """(member, least member) for each non-least member of the parts that pairs connect."""
    up = list(range(m))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    for a, b in pairs.tolist():
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(i, top(i)) for i in range(m) if top(i) != i]


def _by_unit(batches, read, solve, out):
    """Rows in order of unit: ``solve`` each unit's nodes and values, ``out`` a batch of answers."""
    unit, nodes, values, answers = None, [], [], []
    for batch in batches:
        units = tx.column(batch, "unit").to_pylist()
        ids = tx.column(batch, "node").to_pylist()
        get = read(batch)
        for i, u in enumerate(units):
            if u != unit:
                answers += solve(unit, nodes, values)
                unit, nodes, values = u, [], []
            nodes.append(ids[i])
            values.append(get(i))
        if len(answers) > 4096:
            yield out(answers)
            answers = []
    answers += solve(unit, nodes, values)
    yield out(answers)


def _links_out(links):
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()),
                                       pa.array([b for _, b in links], pa.int64())], names=["a", "b"])


def _pruner(num: int, den: int):
    """Rows (unit, node, n, bits) in order of unit -> possible links (a, b), a spanning forest a unit."""
    def read(batch):
        n, bits = tx.column(batch, "n").to_pylist(), tx.column(batch, "bits")
        return lambda i: (n[i], np.frombuffer(bits[i].as_buffer(), np.uint64).copy())

    def solve(unit, nodes, values):
        nodes, at = np.unique(np.array(nodes, dtype=np.int64), return_index=True)
        if len(nodes) < 2:
            return []
        sizes = np.array([values[i][0] for i in at], dtype=np.int64)
        pairs = likely(sizes, [values[i][1] for i in at], num, den)
        return [(int(nodes[i]), int(nodes[j])) for i, j in forest(len(nodes), pairs)]
    return lambda batches: _by_unit(batches, read, solve, _links_out)


def _joiner(num: int, den: int):
    """Rows (unit, node, tokens) in order of unit -> links (a, b), a spanning forest a unit."""
    def read(batch):
        tokens = tx.column(batch, "tokens")
        flat, off = tokens.values.to_numpy(zero_copy_only=False), tokens.offsets.to_numpy()
        return lambda i: np.array(flat[off[i]:off[i + 1]], dtype=np.int64)

    def solve(unit, nodes, sets):
        nodes, at = np.unique(np.array(nodes, dtype=np.int64), return_index=True)
        if len(nodes) < 2:
            return []
        pairs = SignatureTree.of_sets([sets[i] for i in at]).pairs(num, den)
        return [(int(nodes[i]), int(nodes[j])) for i, j in forest(len(nodes), pairs)]
    return lambda batches: _by_unit(batches, read, solve, _links_out)


def _connect(blocks: DataFrame, classes: DataFrame, num: int, den: int, solve) -> DataFrame:
    """(node, root) of the components that ``solve`` finds inside the ``blocks``.

    ``blocks`` (lead, node, n) has every member but the lead; ``solve`` turns members
    (unit, node) into links (a, b).  All pairs of a block end up examined or connected.
    """
    # written, so that joins with it shuffle both sides and a large block's partition can be split
    sizes = materialize(blocks.groupBy("lead").agg(
        F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_TOKENS)).alias("chunks")))
    dealt = blocks.join(sizes, "lead").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    name = F.concat_ws("/", "lead", "chunk").alias("unit")
    found = solve(dealt.select(name, "node").unionAll(dealt.select("lead", "chunk").distinct().select(name, F.col("lead"))))
    parts = components(found)
    # blocks of several chunks that are not one component yet: the pairs of their chunks
    big = dealt.filter("chunks > 1").select("lead", "node", "n", "chunks")
    leads = sizes.filter("chunks > 1").join(classes.select(F.col("node").alias("lead"), "n"), "lead")
    big = big.unionAll(leads.select("lead", F.col("lead").alias("node"), "n", "chunks"))
    big = big.join(parts, "node", "left").withColumn("part", F.coalesce("root", "node"))
    mixed = big.groupBy("lead").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("lead")
    big = materialize(big.join(mixed, "lead").select(
        "lead", "node", "n", F.pmod(F.xxhash64("node"), "chunks").alias("chunk"),
        F.floor(F.log(F.col("n") + 0.5) / F.log(F.lit(den / num))).alias("band")))
    if big.limit(1).count():
        pieces = big.groupBy("lead", "band", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
        a, b = pieces.alias("a"), pieces.alias("b")
        pairs = a.join(b, (F.col("a.lead") == F.col("b.lead"))
                       & (F.struct("a.band", "a.chunk") <= F.struct("b.band", "b.chunk"))
                       & (F.col("b.band") - F.col("a.band") <= 2)
                       & (den * F.col("a.high") >= num * F.col("b.low"))).select(
            F.col("a.lead").alias("lead"),
            F.concat_ws("/", "a.lead", "a.band", "a.chunk", "b.band", "b.chunk").alias("unit"),
            F.array_distinct(F.array(F.struct("a.band", "a.chunk"), F.struct("b.band", "b.chunk"))).alias("sides"))
        pairs = pairs.select("lead", "unit", F.explode("sides").alias("s")).select("lead", "unit", "s.band", "s.chunk")
        more = solve(big.join(pairs, ["lead", "band", "chunk"]).select("unit", "node"))
        release(parts)
        parts = components(found.unionAll(more))
        release(more)
    for x in (big, sizes, found):
        release(x)
    return parts


# --------------------------------------------------------------------- operator

def jaccard_classes(documents: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``documents`` (doc_id, text).

    Documents link when ``den * |A & B| >= num * |A | B|`` on their sets of distinct
    k-word shingles (A-Z lower-cased; fewer than k words: the whole sequence as one).

    Defined cases: a null or empty text, or one without words, has the empty set,
    links with nothing and is its own component.  A row without doc_id gets its
    n_shingles and a null component, and takes no part in links.  A doc_id on
    several rows gives one row each; equal rows share a class.  An empty table gives
    no rows.  Columns beyond doc_id and text are not read, whatever their names.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scan = materialize(docs.mapInArrow(_scanner(k), "doc_id long, n long, hi long, lo long, cell int, seen long"))
    hot = spark.sparkContext.broadcast(_hot_cells(scan))
    rows = scan.filter("n IS NOT NULL")
    classes = materialize(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo")
                          .agg(F.min("doc_id").alias("first_id"), F.max("n").alias("n"))
                          .withColumn("node", F.monotonically_increasing_id()))
    prefixes = materialize(
        docs.filter("doc_id IS NOT NULL").mapInArrow(
            _prefixer(k, num, den, hot), "doc_id long, hi long, lo long, prefix array<long>, bits binary")
        .withColumnRenamed("doc_id", "first_id").join(classes, ["hi", "lo", "first_id"])
        .dropDuplicates(["hi", "lo", "first_id"]).select("node", "n", "prefix", "bits"))
    bitmaps = prefixes.select("node", "n", "bits")
    # blocks: (lead, node) of all sets that share a prefix token with the lead
    tokens = prefixes.select("node", F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.min("node").alias("lead"), F.max("node").alias("last")) \
        .filter("lead <> last").select("token", "lead")
    stars = materialize(tokens.join(shared, "token").filter("lead <> node").select("lead", "node").distinct()
                        .join(classes.select("node", "n"), "node"))

    def possible(members):
        return materialize(members.join(bitmaps, "node").repartition("unit").sortWithinPartitions("unit")
                           .mapInArrow(_pruner(num, den), "a long, b long"))

    def exact(members):
        need = materialize(members.join(classes, "node").select("unit", "node", "hi", "lo", F.col("first_id").alias("doc_id")))
        if need.count() <= SMALL:  # text stays where it is; beyond that both sides shuffle
            need = F.broadcast(need)
        sets = docs.join(need, "doc_id").select("unit", "node", "hi", "lo", "text").mapInArrow(
            _setter(k), "unit string, node long, tokens array<long>")
        return materialize(sets.repartition("unit").sortWithinPartitions("unit").mapInArrow(_joiner(num, den), "a long, b long"))

    groups = _connect(stars, classes, num, den, possible)
    release(prefixes)
    release(stars)
    blocks = groups.filter("node <> root").select(F.col("root").alias("lead"), "node").join(classes.select("node", "n"), "node")
    parts = _connect(blocks, classes, num, den, exact)
    release(groups)
    whole = classes.join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = whole.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = whole.join(least, "root").select("hi", "lo", "component_id")
    return rows.join(labels, ["hi", "lo"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
