"""Exact group percentiles whose memory does not grow with group size.

Semantics: linear interpolation between order statistics at position
``h = p * (n - 1)`` (pandas ``quantile``, SQL ``percentile_cont``); NULLs are
ignored; an empty group has no row.

Spark's exact ``percentile`` aggregate keeps a value -> count map per group and
merges it in one task, so a hot group (a third of all rows, continuous values)
would hold every distinct value in one reducer.  Here, at every size:

1. the input is evaluated once and its needed columns are written;
2. a sketch per group names cuts around the wanted ranks (any cuts give the same result);
3. rows are counted per (group, bucket between cuts), which tells exactly which bucket holds
   each wanted rank; a value that is a cut has a bucket of its own;
4. a bucket of one value answers at once, one of more than ``LEAF`` rows is cut again like a
   group of its own, as often as it takes, and only the rows of what is left are shuffled
   and ranked, bucket by bucket.

Steps 2 and 3 shuffle a row per group and bucket; fact rows are never sorted or grouped by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.session import materialize

ACCURACY = 2000                              # of the sketch, as 1 / relative rank error
CLOSE = 0.004                                # cuts lie this share of the ranks below and above a wanted one
EVEN = [i / 64 for i in range(1, 64)]        # cuts of nested sets and of buckets that are cut again
LEAF = 2_000_000                             # rows of a bucket that are ranked together
MAX_BROADCAST_GROUPS = 100_000


def null_safe_join(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL; keeps one copy of each key column."""
    keys = list(keys)
    if not keys:
        return a.crossJoin(b)
    rb = b.select(*[F.col(c).alias(f"__r_{c}") for c in keys],
                  *[c for c in b.columns if c not in keys])
    cond = [a[c].eqNullSafe(rb[f"__r_{c}"]) for c in keys]
    out = a.join(rb, cond, how)
    if how in ("right", "right_outer", "full", "full_outer", "outer"):
        out = out.select(*[F.coalesce(a[c], rb[f"__r_{c}"]).alias(c) for c in keys],
                         *[c for c in out.columns if c not in keys and not c.startswith("__r_")])
        return out
    return out.drop(*[f"__r_{c}" for c in keys])


def percentiles(df: DataFrame, keys: Sequence[str], value, probs: Sequence[float],
                names: Sequence[str] | None = None, weight: str | None = None) -> DataFrame:
    """Exact percentiles of ``value`` per group of ``keys`` (``weight``: a column of row counts).

    Returns one row per group with at least one non-NULL value: the key
    columns plus one DOUBLE column per probability (``names``).
    """
    names = list(names) if names else [f"p{int(round(p * 100))}" for p in probs]
    return percentiles_multi(df, keys, [(value, probs, names)], weight)


def percentiles_of_metrics(df: DataFrame, keys, metric: str, columns: dict, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Percentiles of several columns, one row per group and column: the name of ``columns`` stands in ``metric``.
    Each row of ``df`` is written once, whatever the number of columns."""
    keep = df.select(*keys).columns
    wide = df.select(*keys, *[F.col(c).alias(f"__{i}") for i, c in enumerate(columns.values())])
    wide._shiplens_materialized = getattr(df, "_shiplens_materialized", False)
    own = [[f"__{i}_{n}" for n in names] for i in range(len(columns))]
    got = percentiles_multi(wide, keep, [(f"__{i}", probs, own[i]) for i in range(len(columns))])
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias(metric), *[F.col(a).alias(n) for a, n in zip(own[i], names)])
                               for i, m in enumerate(columns)])).alias("_e")
    return got.select(*keep, rows).select(*keep, "_e.*").where(F.col(names[0]).isNotNull())


def _cuts(probs: Sequence[float]) -> list[float]:
    """Ranks (as shares) a little below and above each wanted one."""
    return sorted({round(min(max(p + d, 0.0), 1.0), 6) for p in probs for d in (-CLOSE, CLOSE)})


def percentiles_multi(df: DataFrame, keys: Sequence[str], specs, weight: str | None = None,
                      level: str | None = None, sets: int = 1, leaf: int = LEAF) -> DataFrame:
    """Percentiles of several columns per group in one pass: ``specs`` is a list of
    (value column, probabilities, output names); a group has a row when one of the
    columns has a non-NULL value in it.  ``weight`` names a column that says how many equal
    rows each row stands for.

    With ``level`` (a column of 0 .. ``sets`` - 1) a group has ``sets`` nested sets, set s of the rows
    whose level is at most s; the output names of a spec are then one list per set.
    """
    keys = list(keys)
    specs = [(v, list(probs), names if level else [names]) for v, probs, names in specs]
    node = [*keys, "_m", "_p"]
    one = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    at = F.lit(0) if level is None else F.col(level).cast("int")
    wide = df.select(*keys, one.alias("_w"), at.alias("_l"), *[
        (F.col(v) if isinstance(v, str) else v).cast("double").alias(f"_x{m}") for m, (v, _, _) in enumerate(specs)])
    if not getattr(df, "_shiplens_materialized", False):
        wide = materialize(wide)        # several scans, one evaluation
    vals = wide.select(*keys, "_w", "_l", F.lit(0).cast("long").alias("_p"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.col(f"_x{m}").alias("x")) for m in range(len(specs))])).alias("_v")) \
        .select(*keys, F.col("_v.m").alias("_m"), "_p", "_w", "_l", F.col("_v.x").alias("_x")).where(F.col("_x").isNotNull())
    shares = EVEN if sets > 1 else _cuts([p for _, probs, _ in specs for p in probs])
    result = [*keys, "_m", "_s", "_i", "_h", "_hi", "_x"]
    ask, answers = None, []
    while True:
        cuts = materialize(vals.groupBy(*node).agg(
            F.array_distinct(F.percentile_approx("_x", shares, ACCURACY)).alias("_cuts")))
        few = cuts.count() <= MAX_BROADCAST_GROUPS         # a row a group; otherwise a shuffle join
        binned = null_safe_join(vals, F.broadcast(cuts) if few else cuts, node).select(
            *node, "_w", "_l", "_x", (2 * F.size(F.filter("_cuts", lambda c: c < F.col("_x")))
                                      + F.array_contains("_cuts", F.col("_x")).cast("int")).alias("_b"))
        counts = materialize(binned.groupBy(*node, "_b").agg(
            *[F.coalesce(F.sum(F.when(F.col("_l") <= s, F.col("_w"))), F.lit(0)).alias(f"_c{s}") for s in range(sets)],
            F.min("_x").alias("_least"), F.max("_x").alias("_most"), F.count(F.lit(1)).alias("_rows")))
        wanted = _located(counts, node, sets, specs, ask)
        one_value = F.col("_least") == F.col("_most")
        answers.append(wanted.where(one_value).withColumnRenamed("_least", "_x").select(*result))
        open_ = wanted.where(~one_value)
        width = 2 * len(shares) + 1
        below = (F.col("_p") * width + F.col("_b")).alias("_p")
        buckets = open_.select(*node, "_b").distinct()
        vals = materialize(null_safe_join(binned, F.broadcast(buckets) if few else buckets, [*node, "_b"]).select(
            *keys, "_m", below, "_l", "_x", "_w").groupBy(*node, "_l", "_x").agg(F.sum("_w").alias("_w")))
        ask = open_.select(*keys, "_m", below, "_s", "_i", "_h", "_hi", "_at")
        if (open_.agg(F.max("_rows")).first()[0] or 0) <= leaf:
            break
        shares = EVEN
    answers.append(_ranked(vals, ask, node, sets).select(*result))
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    found = found.groupBy(*keys, "_m", "_s", "_i").agg(
        F.max(F.when(F.col("_hi") == 0, F.col("_x"))).alias("_xl"),
        F.max(F.when(F.col("_hi") == 1, F.col("_x"))).alias("_xh"), F.max("_h").alias("_h"))
    frac = F.col("_h") - F.floor(F.col("_h"))
    # weighted form lo*(1-d) + hi*d: an exact midpoint is rounded once (same bits as SQL engines)
    found = found.withColumn("_val", F.col("_xl") * (F.lit(1e0) - frac) + F.col("_xh") * frac)
    return found.groupBy(*keys).agg(*[
        F.max(F.when((F.col("_m") == m) & (F.col("_s") == s) & (F.col("_i") == i), F.col("_val"))).alias(n)
        for m, (_, _, names) in enumerate(specs) for s, own in enumerate(names) for i, n in enumerate(own)])


def _located(counts: DataFrame, node: list[str], sets: int, specs, ask: DataFrame | None) -> DataFrame:
    """The bucket that holds each asked rank, and the rank inside it (``_at``); without ``ask`` the
    ranks are those of the probabilities, two each."""
    group = Window.partitionBy(*node)
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = counts.select(*node, "_b", "_least", "_most", "_rows", F.array(*[F.struct(
            F.lit(s).alias("s"), F.col(f"_c{s}").alias("c"), F.sum(f"_c{s}").over(upto).alias("e"), F.sum(f"_c{s}").over(group).alias("n"))
            for s in range(sets)]).alias("_t")).withColumn("_t", F.explode("_t"))
    per = per.select(*node, "_b", "_least", "_most", "_rows", F.col("_t.s").alias("_s"), F.col("_t.c").alias("_c"),
                     (F.col("_t.e") - F.col("_t.c")).alias("_before"), F.col("_t.n").alias("_n")).where("_c > 0")
    if ask is None:
        ranks = F.element_at(F.array(*[F.array(*[
            F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("h")) for i, p in enumerate(probs)])
            for _, probs, _ in specs]), F.col("_m") + 1)
        asked = per.withColumn("_r", F.explode(ranks)).withColumn("_q", F.explode(F.array(
            F.struct(F.lit(0).alias("hi"), F.floor("_r.h").alias("at")), F.struct(F.lit(1).alias("hi"), F.ceil("_r.h").alias("at")))))
        asked = asked.select(*per.columns, F.col("_r.i").alias("_i"), F.col("_r.h").alias("_h"), F.col("_q.hi").alias("_hi"), F.col("_q.at").alias("_at"))
    else:
        asked = null_safe_join(per, ask, [*node, "_s"])
    inside = (F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_c"))
    return materialize(asked.where(inside).withColumn("_at", F.col("_at") - F.col("_before")).drop("_before", "_c", "_n"))


def _ranked(vals: DataFrame, ask: DataFrame, node: list[str], sets: int) -> DataFrame:
    """Rank the rows of the last buckets, each bucket by itself, and pick the asked ranks."""
    rows = vals.groupBy(*node, "_x").agg(F.array(*[
        F.coalesce(F.sum(F.when(F.col("_l") <= s, F.col("_w"))), F.lit(0)) for s in range(sets)]).alias("_f"))
    w = Window.partitionBy(*node).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.withColumn("_e", F.array(*[F.sum(F.col("_f")[s]).over(w) for s in range(sets)]))
    want = ask.groupBy(*node).agg(F.collect_list(F.struct(          # two per probability and set
        *[F.col(f"_{c}").alias(c) for c in ("s", "i", "h", "hi", "at")])).alias("_want"))
    hits = null_safe_join(ends, want, node).withColumn("_t", F.explode(F.filter("_want", lambda t: (
        (t["at"] < F.col("_e")[t["s"]]) & (t["at"] >= F.col("_e")[t["s"]] - F.col("_f")[t["s"]])))))
    return hits.select("*", *[F.col(f"_t.{c}").alias(f"_{c}") for c in ("s", "i", "h", "hi")])


def median(df: DataFrame, keys: Sequence[str], value, name: str = "median") -> DataFrame:
    return percentiles(df, keys, value, [0.5], [name])
