"""Operator 5 - nearest neighbours by a block matrix join on int8 tiles.

Queries come in blocks of bounded bytes that are broadcast one at a time; candidates
stay where they are scanned.  For every tile (query block x candidate batch):

1. Both sides are quantised to int8 with a scale per vector, and the exact length of
   what quantisation lost, ``e = |v - s * q|``, is kept.
2. One integer-valued matrix product gives the distance of the dequantised vectors.  By
   the triangle inequality the true distance is within ``e_q + e_c`` of it.
3. Pairs whose lower bound lies above the query's k-th best distance so far (or the
   k-th smallest upper bound of the tile) cannot be among the nearest; the others are
   recomputed in double precision on the original vectors.
4. A heap per query keeps the k best of the task; tasks' heaps are merged by a top-k per
   query over at most k rows a task and query.

The bounds hold for every pair, so the result is exact (recall 1).
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.llm import textops as tx
from shiplens.session import materialize

K = 10
QUERY_BLOCK_BYTES = 8 << 20   # doubles of the queries in one broadcast block
TILE_ROWS = 2048              # candidates in one tile


class Tile:
    """Vectors of one dimension with their int8 form, scales and error lengths."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        self.ids, self.v = ids, v
        self.scale = np.abs(v).max(axis=1) / 127.0
        q = np.rint(v / self.scale[:, None])
        self.q = q.astype(np.int8)
        near = q * self.scale[:, None]
        self.err = np.sqrt(((v - near) ** 2).sum(axis=1))
        self.norm = (near ** 2).sum(axis=1)


def usable(ids: pa.Array, vectors: pa.Array) -> dict[int, Tile]:
    """Tiles by dimension; null, empty, zero and non-finite vectors and null ids are left out."""
    ok = np.ones(len(ids), bool)
    if ids.null_count:
        ok &= ids.is_valid().to_numpy(zero_copy_only=False)
    if vectors.null_count:
        ok &= vectors.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(ok)
    if not len(rows):
        return {}
    vectors = vectors.take(pa.array(rows))
    key = ids.take(pa.array(rows)).to_numpy(zero_copy_only=False)
    off = vectors.offsets.to_numpy()
    flat = vectors.values
    flat = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component becomes NaN
    dims = np.diff(off)
    out = {}
    for d in np.unique(dims).tolist():
        if d == 0:
            continue
        at = np.flatnonzero(dims == d)
        v = flat[off[at][:, None] + np.arange(d)]
        good = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
        if good.any():
            out[d] = Tile(key[at][good].astype(np.int64), v[good])
    return out


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of row pairs, components summed in order."""
    acc = np.zeros(len(a))
    for j in range(a.shape[1]):
        d = a[:, j] - b[:, j]
        acc += d * d
    return np.sqrt(acc)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dot products of int8 rows, exact: 1024 components at a time fit a float32 product."""
    out = np.zeros((len(q), len(c)))
    for j in range(0, q.shape[1], 1024):
        out += q[:, j:j + 1024].astype(np.float32) @ c[:, j:j + 1024].astype(np.float32).T
    return out


def search_tile(queries: Tile, cand: Tile, heaps: list[list], k: int) -> None:
    """Merge the tile's nearest candidates into the heaps of (-distance, -vec_id)."""
    dot = _products(queries.q, cand.q) * (queries.scale[:, None] * cand.scale[None, :])
    near = np.sqrt(np.maximum(queries.norm[:, None] + cand.norm[None, :] - 2 * dot, 0))
    slack = queries.err[:, None] + cand.err[None, :]
    # rounding of the arithmetic above, far above what doubles lose
    slack += 1e-6 * (np.sqrt(queries.norm)[:, None] + np.sqrt(cand.norm)[None, :])
    upper = near + slack
    upper[queries.ids[:, None] == cand.ids[None, :]] = np.inf
    bound = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps])
    if upper.shape[1] >= k:
        bound = np.minimum(bound, np.partition(upper, k - 1, axis=1)[:, k - 1])
    qi, ci = np.nonzero((near - slack <= bound[:, None]) & (queries.ids[:, None] != cand.ids[None, :]))
    for s in range(0, len(qi), 1 << 14):
        a, b = qi[s:s + (1 << 14)], ci[s:s + (1 << 14)]
        for i, j, d in zip(a.tolist(), b.tolist(), exact(queries.v[a], cand.v[b]).tolist()):
            entry, h = (-d, -int(cand.ids[j])), heaps[i]
            if len(h) < k:
                heapq.heappush(h, entry)
            elif entry > h[0]:
                heapq.heapreplace(h, entry)


def _searcher(block, k: int):
    def run(batches):
        tiles = {d: Tile(i, v) for d, (i, v) in block.value.items()}
        heaps = {d: [[] for _ in t.ids] for d, t in tiles.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(at, TILE_ROWS)
                for d, cand in usable(tx.column(part, "vec_id"), tx.column(part, "embedding")).items():
                    for s in range(0, len(tiles[d].ids) if d in tiles else 0, 512):
                        t = tiles[d]
                        view = Tile.__new__(Tile)
                        for name in ("ids", "v", "scale", "q", "err", "norm"):
                            setattr(view, name, getattr(t, name)[s:s + 512])
                        search_tile(view, cand, heaps[d][s:s + 512], k)
        for d, t in tiles.items():
            out = [(int(q), -c, -x) for q, h in zip(t.ids, heaps[d]) for x, c in h]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def nearest(embeddings: DataFrame, is_query, k: int = K, block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k nearest other rows.

    ``is_query`` is a boolean Column on vec_id.  Nearness is the Euclidean distance in double
    precision, smallest first, ties to the smaller vec_id.

    Defined cases: rows without vec_id and vectors that are null, empty, zero or hold a
    null or non-finite component take no part, as query or candidate.  Vectors of
    different dimension are never compared.  Of rows with the same vec_id and the same
    vector one counts; a vec_id with several vectors counts with each of them (its
    nearest ranks first, a candidate id may then appear once per distance), and is never
    its own neighbour.  Fewer than k candidates are all returned.  An empty table gives
    no rows.  Further columns are not read.
    """
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    queries = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & is_query)
    stats = queries.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")).first()
    blocks = max(1, -(-stats["n"] * 8 * (stats["d"] or 1) // block_bytes))
    found = None
    for b in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).dropDuplicates().toArrow()  # block_bytes
        rows = rows.combine_chunks().to_batches()
        shared = spark.sparkContext.broadcast(
            {d: (t.ids, t.v) for d, t in (usable(tx.column(rows[0], "vec_id"), tx.column(rows[0], "embedding"))
                                         if rows else {}).items()})
        part = vectors.mapInArrow(_searcher(shared, k), "query_id long, vec_id long, score double")
        if blocks > 1:
            part = materialize(part)
        found = part if found is None else found.unionAll(part)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
