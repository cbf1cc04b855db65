"""Operator 2 - mixing sources to target weights by Sainte-Lague apportionment.

1. Sources weigh by a repeating pattern and share all words; a target stops at ``cap``
   times its source's size and the excess is shared again by weight.
2. The mix is made of equal blocks of ``block`` words.  Sainte-Lague gives every source an
   integer number of blocks: seat by seat to the highest quotient target / (2 * seats + 1).
   Targets below ``FINE`` blocks, and those of capped sources, are apportioned by the same rule
   in single words.
   The same rule splits a source's quota over ranges of its shards, then over the shards of each
   range, by size: no task sees more than ``RANGE`` shards or all ranges of one source.
3. A shard (a bounded part of one source, documents in seeded order) lays its documents
   end to end and takes the words of its quota: whole passes while they exceed its own,
   then blocks in the order of their seeded hashes, the last one up to the word that fills
   the quota.  A document takes its words that lie in taken blocks, once for every pass.

Text never moves: word counts are taken in the scan and (doc_id, source, size) is all that
is shuffled.  Shards hold a bounded number of words whatever the size of a source.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.llm import textops as tx
from shiplens.session import materialize

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK = 32                 # words of a block
SHARD_WORDS = 1 << 19      # words of a shard, about
SEED = 17
FINE = 16                  # blocks; smaller targets are apportioned word by word
RANGE = 1 << 12            # shards of a range


def sainte_lague(weights, seats: int, most=None) -> np.ndarray:
    """Seats by highest quotients w / (2 s + 1), never above ``most``; ties to the first.

    The bulk of the seats is given at once (by a divisor that gives no seat too many), the
    rest one by one from a heap, so the result is that of the seat-by-seat rule.
    """
    w = np.asarray(weights, dtype=np.float64)
    most = np.full(len(w), seats) if most is None else np.asarray(most, dtype=np.int64)
    got = np.zeros(len(w), dtype=np.int64)
    seats = int(min(seats, most[w > 0].sum()))
    if seats <= 0 or not (w > 0).any():
        return got

    def at(d):  # seats at a divisor: they fall as it grows
        return np.minimum(np.floor(w / d + 0.5).astype(np.int64), most)
    low, high = w.sum() / (seats * 4 + 4 * len(w)), float(w.max()) * 2 + 1
    while at(low).sum() < seats and low > 0 and (at(low) < most)[w > 0].any():
        low /= 2
    for _ in range(60):
        mid = (low + high) / 2
        if at(mid).sum() > seats:
            low = mid
        else:
            high = mid
    got = at(high)  # not above the seats to give
    left = seats - int(got.sum())
    heap = [(-w[i] / (2 * got[i] + 1), i) for i in range(len(w)) if w[i] > 0 and got[i] < most[i]]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-w[i] / (2 * got[i] + 1), i))
    return got


def _counter(batches):
    for batch in batches:
        for part in tx.slices(batch, "text"):
            w = tx.Words(tx.column(part, "text"))
            yield pa.RecordBatch.from_arrays([tx.column(part, "doc_id"), tx.column(part, "source"),
                                              pa.array(np.diff(w.first), pa.int64()),
                                              pa.array(w.hash_ranges(w.offsets[:-1], w.offsets[1:]).view(np.int64), pa.int64())],
                                             names=["doc_id", "source", "size", "mark"])


def sized(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, mark): words [^\\x20\\x09-\\x0D]+ of every text, 0 for null, and a hash of the text."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            F.col("text").cast("string").alias("text")).mapInArrow(
        _counter, "doc_id long, source string, size long, mark long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) for every source of ``sizes`` (source, size).

    Sources in code point order, null last, take ``weights`` in turn.  Capping and sharing
    again until nothing is above its cap ends where a single level ``x`` gives every source
    ``min(cap * size, x * weight)``; with the sources in order of ``cap * size / weight`` that
    level is read off running sums.  The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (F.pmod(F.row_number().over(name) - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("top", (cap * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    per = per.withColumn("total", F.sum("source_size").over(everything).cast("double")) \
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
                    / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the first source in this order that its own level does not fill sets the level of all after it
    free = F.col("top") > F.col("level") * F.col("weight")
    per = per.withColumn("x", F.first(F.when(free, F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return per.select("source", "source_size",
                      F.when(F.col("x").isNull(), F.col("top")).otherwise(F.least("top", F.col("x") * F.col("weight"))).alias("target"))


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    return tx.mix64(x.astype(np.uint64) + tx.mix64(np.array([seed], np.uint64)))


def _taker(block: int, seed: int):
    def take(pdf):
        """One shard: its documents in seeded order, its quota of blocks."""
        pdf = pdf.sort_values(["place", "doc_id", "size"], na_position="last")
        size = pdf["size"].to_numpy(np.int64)
        end = np.cumsum(size)
        total = int(end[-1])
        n = -(-total // block)
        passes, rest = divmod(int(pdf["quota"].iloc[0]), total) if total else (0, 0)
        got = np.zeros(n, np.int64)  # words taken of each block, from its beginning
        if rest:
            width = np.full(n, block, np.int64)
            width[-1] = total - (n - 1) * block
            order = np.argsort(_mix(np.arange(n) + int(pdf["shard"].iloc[0]) * 1_000_003, seed), kind="stable")
            before = np.cumsum(width[order]) - width[order]
            got[order] = np.clip(rest - before, 0, width[order])
        upto = np.concatenate([[0], np.cumsum(got)])

        def words(p):  # taken words among the first p of the shard
            b = p // block
            return upto[b] + np.minimum(p - b * block, np.append(got, 0)[b])
        pdf["taken"] = passes * size + words(end) - words(end - size)
        return pdf[["doc_id", "size", "source_size", "target", "taken"]]
    return take


def mix_sources(documents: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK,
                shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``documents``.

    Defined cases: a null text has size 0; a null source is a source of its own, last in
    order.  A null doc_id is a document like any other.  Repeated rows are separate
    documents.  Sources without words have target 0 and take nothing.  An empty table gives
    no rows.  Columns beyond doc_id, text and source are not read.  Reruns give the same
    rows (order aside): places and blocks depend on ids, sizes and the seed alone.
    """
    # rows alike in all (a null doc_id may stand in many) are told apart by their number, so that they spread
    alike = sized(documents).groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("n"))
    sizes = materialize(alike.select("doc_id", "source", "size", "mark", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")))
    full = F.col("target") >= cap * F.col("source_size")
    unit = F.when(full | (F.col("target") < FINE * block), 1).otherwise(block)
    # shards of about shard_words words; a document's shard and place follow from its content alone
    targets = materialize(source_targets(sizes, weights, cap).withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)))
                          .withColumn("unit", unit))

    def apportion(pdf):
        pdf = pdf.sort_values("source", na_position="last", kind="stable").reset_index(drop=True)
        u = int(pdf["unit"].iloc[0])
        most = cap * pdf["source_size"].to_numpy(np.int64) // u
        pdf["words"] = u * sainte_lague(pdf["target"], round(pdf["target"].sum() / u), most)
        return pdf[["source", "source_size", "target", "unit", "words"]]

    quotas = targets.groupBy("unit").applyInPandas(  # one row per source
        apportion, "source string, source_size long, target double, unit int, words long")
    ids = ["doc_id", "size", "mark", "copy"]
    dealt = sizes.join(targets.select(F.col("source").alias("s"), "shards"), F.col("source").eqNullSafe(F.col("s"))) \
        .select("doc_id", "source", "size", F.pmod(F.xxhash64(F.lit(seed), *ids), "shards").alias("shard"),
                F.xxhash64(F.lit(seed + 1), *ids).alias("place"))
    per_shard = materialize(dealt.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")).join(
        quotas.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select("source", "shard", F.floor(F.col("shard") / RANGE).alias("part"), "shard_size", F.floor(cap * F.col("shard_size") / F.col("unit")).alias("most"),
                "source_size", "target", "unit", "words"))

    def split(by, size, of):
        def run(pdf):
            pdf = pdf.sort_values(by).reset_index(drop=True)
            u = int(pdf["unit"].iloc[0])
            pdf["quota"] = u * sainte_lague(pdf[size].to_numpy(np.int64), int(pdf[of].iloc[0]) // u, pdf["most"].to_numpy(np.int64))
            return pdf[["source", by, *(["source_size", "target"] if by == "shard" else []), "quota"]]
        return run

    per_part = per_shard.groupBy("source", "part").agg(F.sum("shard_size").alias("part_size"), F.sum("most").alias("most"),
                                                       F.first("unit").alias("unit"), F.first("words").alias("words")) \
        .groupBy("source").applyInPandas(split("part", "part_size", "words"), "source string, part long, quota long")
    shard_quotas = per_shard.join(per_part.select(F.col("source").alias("s"), F.col("part").alias("p"), F.col("quota").alias("part_words")),
                                  F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))) \
        .groupBy("source", "part").applyInPandas(split("shard", "shard_size", "part_words"),
                                                 "source string, shard long, source_size long, target double, quota long")
    shard_quotas = materialize(shard_quotas).select(F.col("source").alias("s"), F.col("shard").alias("d"),
                                                    "source_size", "target", "quota")
    return dealt.join(shard_quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("d"))) \
        .select("source", "shard", "doc_id", "size", "place", "source_size", "target", "quota") \
        .groupBy("source", "shard").applyInPandas(
            _taker(block, seed), "doc_id long, size long, source_size long, target double, taken long")
