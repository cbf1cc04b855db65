"""Operator 8 - line deduplication with two Bloom filters.

A line's key is the line without white space at both ends, A-Z lower-cased.  Keys of
at least ``min_chars`` code points that occur in two documents or more keep their lines
only in the smallest ``doc_id`` that holds them.

1. Every task fills two Bloom filters over its documents' keys: *once* (seen) and
   *twice* (seen in a second document).  Merging two tasks' filters is bitwise:
   ``twice = twice_a | twice_b | (once_a & once_b)``, ``once = once_a | once_b``; it
   runs as a shuffle of compressed filter slabs, one slab in memory at a time.  A
   repeated key has all its bits in the merged *twice* filter: no repeat is missed.
2. Only keys the twice filter suspects are shuffled, as 128-bit digests with their
   doc_id.  ``min`` and ``max`` of doc_id per digest (summed map-side) confirm a repeat
   exactly and choose the first document.
3. Drop lists go back to their documents by doc_id.

The filter has about 16 bits per expected line, at most ``MAX_BITS`` (64 MB a filter), so
what is broadcast has a fixed bound.  Beyond that size it suspects more keys, which
costs shuffle and changes no result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx
from shiplens.session import materialize

MIN_CHARS = 10
MIN_BITS, MAX_BITS = 1 << 20, 1 << 29
BITS_PER_ROW = 160        # about 10 lines a document, 16 bits a line
SLAB = 1 << 13            # bytes of a filter slab


def _positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    m = np.uint64(bits - 1)
    return (h & m).astype(np.int64), ((h >> np.uint64(32)) & m).astype(np.int64)


def _has(filt: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return (filt[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1


def _add(filt: np.ndarray, pos: np.ndarray) -> None:
    np.bitwise_or.at(filt, pos >> 3, np.left_shift(np.uint8(1), (pos & 7).astype(np.uint8)))


def _filler(bits: int, min_chars: int):
    def run(batches):
        once, twice = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                lines = tx.Lines(tx.column(part, "text"))
                ids = tx.column(part, "doc_id").to_numpy(zero_copy_only=False)
                long_ = np.flatnonzero(lines.chars >= min_chars)
                h, doc = lines.hashes()[long_], ids[lines.row[long_]]
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)  # one of each key and document
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h = h[new]
                head = np.ones(len(h), bool)
                head[1:] = h[1:] != h[:-1]
                again = np.zeros(len(h), bool)
                again[1:] = ~head[1:]
                p, q = _positions(h, bits)
                seen = again | (_has(once, p) & _has(once, q))
                for pos in (p, q):
                    _add(twice, pos[seen])
                for pos in (p, q):
                    _add(once, pos)
        live = np.flatnonzero(once.reshape(-1, min(SLAB, len(once))).any(axis=1))
        for s in live.tolist():
            a, b = once[s * SLAB:(s + 1) * SLAB], twice[s * SLAB:(s + 1) * SLAB]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([zlib.compress(a.tobytes(), 1)], pa.binary()),
                 pa.array([zlib.compress(b.tobytes(), 1)], pa.binary())], names=["slab", "once", "twice"])
    return run


def _merge(batches):
    """Rows in order of slab -> one row a slab with its merged twice filter."""
    def out(s, b):
        return pa.RecordBatch.from_arrays([pa.array([s], pa.int32()),
                                           pa.array([zlib.compress(b.tobytes(), 1)], pa.binary())],
                                          names=["slab", "twice"])
    slab, once, twice = None, None, None
    for batch in batches:
        for s, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
            a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
            if s != slab:
                if slab is not None and twice.any():
                    yield out(slab, twice)
                slab, once, twice = s, a.copy(), b.copy()
            else:
                twice |= b | (once & a)
                once |= a
    if slab is not None and twice.any():
        yield out(slab, twice)


def twice_filter(docs: DataFrame, min_chars: int = MIN_CHARS) -> np.ndarray:
    """The merged twice filter of (doc_id, text): a packed bit array of bounded size."""
    want = docs.count() * BITS_PER_ROW
    bits = min(MAX_BITS, max(MIN_BITS, 1 << max(0, int(want) - 1).bit_length()))
    slabs = docs.filter("doc_id IS NOT NULL").mapInArrow(
        _filler(bits, min_chars), "slab int, once binary, twice binary")
    merged = slabs.repartition("slab").sortWithinPartitions("slab").mapInArrow(_merge, "slab int, twice binary")
    filt = np.zeros(bits >> 3, np.uint8)
    for r in merged.collect():  # bounded by the filter size
        filt[r["slab"] * SLAB:(r["slab"] + 1) * SLAB] = np.frombuffer(zlib.decompress(r["twice"]), np.uint8)
    return filt


def _key(lines: tx.Lines, i: int) -> tuple[int, int]:
    d = hashlib.blake2b(lines.text(i), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _suspecter(filt, min_chars: int):
    def run(batches):
        twice = filt.value
        bits = len(twice) << 3
        for batch in batches:
            for part in tx.slices(batch, "text"):
                lines = tx.Lines(tx.column(part, "text"))
                ids = tx.column(part, "doc_id").to_numpy(zero_copy_only=False)
                at = np.flatnonzero(lines.chars >= min_chars)
                p, q = _positions(lines.hashes()[at], bits)
                at = at[_has(twice, p) & _has(twice, q)]
                found = {(int(ids[lines.row[i]]), *_key(lines, i)) for i in at.tolist()}
                cols = list(zip(*found)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "k1", "k2"])
    return run


def _dropper(min_chars: int):
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                arr = tx.column(part, "text")
                lines = tx.Lines(arr)
                drops = tx.column(part, "drops").to_pylist()
                n_lines = np.diff(lines.first)
                kept, dropped = [], []
                for i, lost in enumerate(drops):
                    a, b = int(lines.first[i]), int(lines.first[i + 1])
                    if not lost:
                        kept.append(lines.raw[lines.offsets[i]:lines.offsets[i + 1]].tobytes())
                        dropped.append(0)
                        continue
                    lost = {(x["k1"], x["k2"]) for x in lost}
                    stay = [j for j in range(a, b) if lines.chars[j] < min_chars or _key(lines, j) not in lost]
                    kept.append(b"\n".join(lines.raw[lines.whole_start[j]:lines.whole_end[j]].tobytes() for j in stay))
                    dropped.append(b - a - len(stay))
                yield pa.RecordBatch.from_arrays(
                    [tx.column(part, "row"), pa.array(kept, pa.binary()).cast(pa.string()),
                     pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64())],
                    names=["row", "kept", "n_lines", "n_dropped"])
    return run


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows (row, kept, n_lines, n_dropped): the input row as a struct, its text without repeats.

    ``documents`` needs doc_id and text; all its columns come back inside ``row``, so
    further columns may have any name.

    Defined cases: a null or empty text is one empty line and stays '' (``kept`` is never
    null).  A row without doc_id keeps all its lines and makes no other line a repeat.
    Rows with the same doc_id are one document: a line in two of them is no repeat by
    itself, and both keep or lose it alike.  Blank and short lines always stay.  An
    empty table gives no rows.
    """
    spark = documents.sparkSession
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                              F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = packed.select("doc_id", "text")
    filt = spark.sparkContext.broadcast(twice_filter(docs, min_chars))
    suspects = materialize(docs.filter("doc_id IS NOT NULL").mapInArrow(
        _suspecter(filt, min_chars), "doc_id long, k1 long, k2 long"))
    # written, so that the join below shuffles both of its sides and a frequent line's partition can be split
    repeats = materialize(suspects.groupBy("k1", "k2").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
                          .filter("keeper < last").select("k1", "k2", "keeper"))
    drops = suspects.join(repeats, ["k1", "k2"]).filter("doc_id <> keeper") \
        .groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("drops"))
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType),
                           T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType())])
    return packed.join(drops, "doc_id", "left").select("row", "text", "drops").mapInArrow(_dropper(min_chars), schema)
