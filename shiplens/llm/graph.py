"""Connected components of a link table as Spark joins, for the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.session import materialize, release


def _mark(links: DataFrame) -> tuple:
    """Count and XOR of row hashes: equal for equal sets of distinct rows."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that links lead to, for every node of ``links`` (a, b long).

    Alternating star contraction: each round points every node's larger
    neighbours, then its smaller ones, at the least node it knows.  Rounds grow
    with the logarithm of the longest chain; each ends in a written table, and a
    node never gathers more than one row per link (only min() per node, so a hub
    is summed map-side).
    """
    cur = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter("a <> b").distinct())
    mark = _mark(cur)
    while True:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        least2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least2, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").filter("a <> b").distinct())
        new = materialize(small)
        release(cur)
        cur, last, mark = new, mark, _mark(new)
        if mark == last:
            break
    stars = cur.groupBy("a").agg(F.min("b").alias("root"))
    roots = cur.select(F.col("b").alias("a")).distinct().select("a", F.col("a").alias("root"))
    out = materialize(stars.unionAll(roots).select(F.col("a").alias("node"), "root"))
    release(cur)
    return out
