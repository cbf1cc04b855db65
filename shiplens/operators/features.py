"""Feature pipeline.

Scale notes
-----------
* M1 needs "first floor(0.8 n) rows by ship date".  No global sort or
  unpartitioned window: the cut position is located by counting over
  successively finer keys (day -> order-key block -> order key -> row), each
  level a small aggregate with a cumulative sum over at most a few thousand
  rows; only the rows of one order key are ever ranked together.
* M3/M4 (trailing 30-day route median, same day excluded): counts per (route,
  day, value bucket) are summed over the trailing days and name the bucket of the
  middle ranks; exact values are read only there.
* Encodings (M2/M5) are one aggregate over all encoded columns at once
  (unpivoted), then joined back; the encoding table has one row per category.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions import refdata as rd
from shiplens.functions import scalars as sc
from shiplens.functions.quantiles import percentiles_multi
from shiplens.functions.stats import COST, TIME, cnt, r6
from shiplens.operators.rules import AS_OF_DATE
from shiplens.session import materialize, materialize_small

TARGETS = {"time": TIME, "cost": COST}
LABELS = dict(TARGETS, zones=TIME)   # of each model: the zones-only one predicts transit days too
ENC_COLUMNS = ["route", "origin_zone", "dest_zone", "carrier", "service_level", "origin_service",
               "carrier_service"]
# total order of the fact rows used by the positional split (the full row is unique)
ORDER_COLUMNS = ["ship_date", "l_orderkey", "l_linenumber", "origin_zone", "dest_zone", "carrier",
                 "service_level", "package_weight_lbs", "package_length_in", "package_width_in",
                 "package_height_in", "package_volume_cubic_in", "insurance_value", TIME, COST]
TRAIN_FRACTION = 0.8


# --------------------------------------------------------------------- M1
def _locate(counts: DataFrame, key: str, cut_col: str, order: Column | str) -> DataFrame:
    """For a small (key, n) table and a one-row cut position, find the key holding the cut:
    returns one row (key_at_cut, rows_before)."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = counts.withColumn("_cum", F.sum("n").over(w))
    hit = c.where((F.col("_cum") - F.col("n") < F.col(cut_col)) & (F.col("_cum") >= F.col(cut_col)))
    return hit.select(F.col(key).alias(f"{key}_at_cut"), (F.col("_cum") - F.col("n")).alias(f"{key}_before"))


def time_split(df: DataFrame, fraction: float = TRAIN_FRACTION, order_columns=ORDER_COLUMNS) -> DataFrame:
    """M1: label rows 'train' (first floor(fraction * n) in ``order_columns`` order) or 'valid'.

    Levels: day -> order-key block (key >> 16) -> order key -> full row.  Each
    level aggregates counts only inside the bucket that holds the cut, with a
    cumulative sum over that small count table.  Joins are against one-row
    results (broadcast).
    """
    df = materialize(df)  # several passes below: scan one written copy
    x = df.withColumn("_blk", F.shiftright(F.col("l_orderkey"), 16))
    # pass 1: rows per day (a calendar-sized table); n and the cut come from it
    days = materialize_small(x.groupBy("ship_date").agg(cnt().alias("n")))
    cut = days.agg(F.floor(F.sum("n") * F.lit(float(fraction))).cast("long").alias("_cut"))
    l1 = _locate(days.crossJoin(F.broadcast(cut)), "ship_date", "_cut", "ship_date").crossJoin(
        F.broadcast(cut)).select("ship_date_at_cut", (F.col("_cut") - F.col("ship_date_before")).alias("_k1"))
    # pass 2: rows per order key inside the cut day only (bounded by one day's orders)
    keys = materialize_small(
        x.join(F.broadcast(l1), F.col("ship_date") == F.col("ship_date_at_cut"))
         .groupBy("_blk", "l_orderkey").agg(cnt().alias("n")))
    # order-key block, then order key: cumulative sums over small tables
    blks = keys.groupBy("_blk").agg(F.sum("n").alias("n")).crossJoin(F.broadcast(l1.select("_k1")))
    l2 = _locate(blks, "_blk", "_k1", "_blk").crossJoin(F.broadcast(l1)).select(
        "ship_date_at_cut", "_blk_at_cut", (F.col("_k1") - F.col("_blk_before")).alias("_k2"))
    inblk = keys.join(F.broadcast(l2), F.col("_blk") == F.col("_blk_at_cut")).select(
        "l_orderkey", "n", "_k2")
    l3 = _locate(inblk, "l_orderkey", "_k2", "l_orderkey").crossJoin(F.broadcast(l2)).select(
        "ship_date_at_cut", "_blk_at_cut", "l_orderkey_at_cut",
        (F.col("_k2") - F.col("l_orderkey_before")).alias("_k3"))
    # the cut coordinates are one row: materialise them so the labelling plan stays flat
    l3 = materialize_small(l3)
    if not l3.take(1):
        # cut = 0 has no key holding the cut: every row is 'valid'
        return x.crossJoin(F.broadcast(materialize_small(cut))).where(F.col("_cut") == 0).select(*df.columns, F.lit("valid").alias("split"))
    # level 4: rows of the cut order key, ranked by the remaining columns (a handful of rows)
    x3 = x.join(F.broadcast(l3), (F.col("ship_date") == F.col("ship_date_at_cut"))
                & (F.col("l_orderkey") == F.col("l_orderkey_at_cut")))
    rest = [c for c in order_columns if c not in ("ship_date", "l_orderkey")]
    x3 = x3.withColumn("_rn", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*rest)))
    at_key = x3.select(*df.columns, F.when(F.col("_rn") <= F.col("_k3"), "train").otherwise("valid")
                       .alias("split"))
    # every other row is placed by comparing its coordinates with the cut
    lab = x.crossJoin(F.broadcast(l3))
    day, cday = F.col("ship_date"), F.col("ship_date_at_cut")
    before = ((day < cday) | ((day == cday) & (F.col("_blk") < F.col("_blk_at_cut")))
              | ((day == cday) & (F.col("_blk") == F.col("_blk_at_cut"))
                 & (F.col("l_orderkey") < F.col("l_orderkey_at_cut"))))
    at_cut = (day == cday) & (F.col("l_orderkey") == F.col("l_orderkey_at_cut"))
    plain = lab.where(~at_cut).select(*df.columns, F.when(before, "train").otherwise("valid").alias("split"))
    return plain.unionByName(at_key)


def time_split_summary(s: DataFrame) -> DataFrame:
    """M1 query: rows and date range per split (independent of the in-day tie order)."""
    t = time_split(s)
    return t.groupBy("split").agg(cnt().alias("n"), F.min("ship_date").alias("min_date"),
                                  F.max("ship_date").alias("max_date"))


# ------------------------------------------------------------------ M2/M5
def with_keys(s: DataFrame) -> DataFrame:
    """Add the encoded categorical keys as strings (route, origin/carrier::service)."""
    return s.withColumn("route", sc.route_key()).withColumn(
        "origin_service", F.concat(F.col("origin_zone").cast("string"), F.lit("::"), F.col("service_level"))
    ).withColumn("carrier_service", F.concat(F.col("carrier"), F.lit("::"), F.col("service_level")))


def encodings(train: DataFrame, min_samples_leaf: float = 200, smoothing: float = 20,
              columns: Sequence[str] = ENC_COLUMNS) -> DataFrame:
    """M2/M5: smoothed target encoding table (enc_col, category, target, n, mean, enc).

    lambda = 1 / (1 + exp(-(n - k) / s)); enc = prior (1 - lambda) + mean lambda,
    prior = the target mean over ``train``.  Rows are summed once per combination of categories
    (exact decimals), the columns' categories from those sums.
    """
    both = (("time", TIME), ("cost", COST))
    cells = materialize(train.groupBy(*columns).agg(*[a for t, c in both for a in (
        F.sum(F.col(c).cast("decimal(38,7)")).alias(f"_s_{t}"), cnt(c).alias(f"_n_{t}"))]))
    mean = lambda t: F.sum(f"_s_{t}").cast("double") / F.sum(f"_n_{t}")
    long = cells.select(*[f"_{a}_{t}" for t, _ in both for a in "sn"], F.explode(F.array(*[
        F.struct(F.lit(c).alias("enc_col"), F.col(c).cast("string").alias("category")) for c in columns
    ])).alias("_e")).select("*", "_e.enc_col", "_e.category")
    g = long.groupBy("enc_col", "category").agg(*[a for t, _ in both for a in (
        F.sum(f"_n_{t}").alias(f"n_{t}"), mean(t).alias(f"mean_{t}"))])
    pr = cells.agg(*[mean(t).alias(f"prior_{t}") for t, _ in both])
    g = g.crossJoin(F.broadcast(pr))  # one-row priors
    outs = []
    for t in ("time", "cost"):
        lam = F.lit(1e0) / (F.lit(1e0) + F.exp(-(F.col(f"n_{t}") - F.lit(float(min_samples_leaf)))
                                               / F.lit(float(smoothing))))
        enc = F.col(f"prior_{t}") * (F.lit(1e0) - lam) + F.col(f"mean_{t}") * lam
        outs.append(g.select("enc_col", "category", F.lit(t).alias("target"), F.col(f"n_{t}").alias("n"),
                             F.col(f"mean_{t}").alias("mean"), lam.alias("smoothing"), enc.alias("enc"),
                             F.col(f"prior_{t}").alias("prior")))
    # one row per (column, category, target): small; materialised so every join that
    # applies it reads a flat table
    return materialize_small(outs[0].unionByName(outs[1]))


def train_rows(s: DataFrame) -> DataFrame:
    return time_split(s).where(F.col("split") == "train").drop("split")


def target_encoding(s: DataFrame) -> DataFrame:
    """M2 query: training encodings (k=200, s=20) fitted on the train split."""
    e = encodings(with_keys(train_rows(s)), 200, 20)
    return e.select("enc_col", "category", "target", "n", *[r6(c).alias(c) for c in ("mean", "smoothing", "enc",
                                                                                      "prior")])


def serving_encodings(s: DataFrame) -> DataFrame:
    """M5 query: serving encodings (k=100, s=10) on all history."""
    e = encodings(with_keys(s), 100, 10)
    return e.select("enc_col", "category", "target", "n", *[r6(c).alias(c) for c in ("mean", "smoothing", "enc",
                                                                                      "prior")])


# categories of one encoded column that are broadcast (about 64 bytes each); beyond it the join shuffles
BROADCAST_CATEGORIES = 100_000


def apply_encodings(df: DataFrame, enc: DataFrame, columns: Sequence[str] = ENC_COLUMNS) -> DataFrame:
    """Add <col>_te_time / <col>_te_cost; unseen categories get the prior.

    ``enc`` is a written table with one row per category and target.  The categories of
    each column are counted first: a column's map is broadcast when it is known to be
    small, so the fact stays where it is; a larger one is joined by a shuffle.
    """
    pri = enc.groupBy("target").agg(F.first("prior").alias("prior"))
    pr = pri.groupBy().pivot("target", ["time", "cost"]).agg(F.first("prior"))
    out = df.crossJoin(F.broadcast(pr.select(F.col("time").alias("_prior_time"), F.col("cost").alias("_prior_cost"))))
    sizes = {r["enc_col"]: r["n"] for r in enc.groupBy("enc_col").agg(F.count("*").alias("n")).collect()}
    wide = enc.groupBy("enc_col", "category").pivot("target", ["time", "cost"]).agg(F.first("enc"))
    for c in columns:
        m = wide.where(F.col("enc_col") == c).select(F.col("category").alias(f"_k_{c}"),
                                                     F.col("time").alias(f"_et_{c}"), F.col("cost").alias(f"_ec_{c}"))
        if sizes.get(c, 0) <= 2 * BROADCAST_CATEGORIES:  # two rows a category
            m = F.broadcast(m)
        out = out.join(m, F.col(c).cast("string") == F.col(f"_k_{c}"), "left")
        out = out.withColumn(f"{c}_te_time", F.coalesce(F.col(f"_et_{c}"), F.col("_prior_time"))) \
                 .withColumn(f"{c}_te_cost", F.coalesce(F.col(f"_ec_{c}"), F.col("_prior_cost"))) \
                 .drop(f"_k_{c}", f"_et_{c}", f"_ec_{c}")
    return out.drop("_prior_time", "_prior_cost")


def target_encoded_rows(s: DataFrame) -> DataFrame:
    """M2 applied: every row with its 14 encoded columns (train-fitted maps)."""
    ks = with_keys(s)
    enc = encodings(with_keys(train_rows(s)), 200, 20)
    out = apply_encodings(ks, enc)
    encs = [f"{c}_te_{t}" for c in ENC_COLUMNS for t in ("time", "cost")]
    return out.select("l_orderkey", "l_linenumber", "ship_date", "carrier", "service_level", "origin_zone",
                      "dest_zone", *[r6(c).alias(c) for c in encs])


# ------------------------------------------------------------------ M3/M4
WINDOW_DAYS = 30


def _epoch_day(d) -> Column:
    return F.datediff(d, F.lit("1970-01-01").cast("date"))


# quantiles at which the count tree cuts a route's values (most medians of a frame are near the
# route's own), those of the nodes below, and the rows up to which a bucket is read and ranked
ROOT_CUTS = (.1, .2, .3, .35, .4, .43, .46, .48, .5, .52, .54, .57, .6, .65, .7, .8, .9)
NODE_CUTS = tuple(i / 16 for i in range(1, 16))
MEDIAN_LEAF = 8192
MAX_BROADCAST_ROUTES = 100_000


def _middle(pos, upto) -> Column:
    """(bucket, rows before it) of a rank: the first bucket up to which there are more rows than that."""
    b = F.size(F.filter(upto, lambda x: x <= pos))
    return F.struct(b.alias("b"), F.when(b > 0, F.get(upto, b - 1)).otherwise(F.lit(0).cast("long")).alias("cum"))


def _level(vals: DataFrame, ask: DataFrame, days: int, probs) -> tuple[DataFrame, DataFrame]:
    """One level of the count tree: cut every node's values into buckets, and send each asked rank to its bucket.

    A value that is a cut has a bucket of its own, so values that repeat do not stay together with others.

    ``vals`` (_r, _m, _p, _d, _x): the values of the nodes ``_p``; ``ask`` (_r, _m, _p, _td and ``_pos``,
    the rank within the node's values of the frame, or NULL at the root, where both middle ranks are
    made).  Returns the values with their new nodes, and the asked ranks with theirs and with the
    node's least and greatest value and rows.
    """
    node = ["_r", "_m", "_p"]
    cuts = materialize(vals.groupBy(*node).agg(
        F.array_distinct(F.percentile_approx("_x", list(probs), 1000)).alias("_cuts")))
    buckets = 2 * len(probs) + 1
    few = cuts.count() <= MAX_BROADCAST_ROUTES     # a row a node; otherwise AQE joins by a shuffle
    binned = materialize(vals.join(F.broadcast(cuts) if few else cuts, node).select(
        "_r", "_m", "_d", "_x", "_p", (2 * F.size(F.filter("_cuts", lambda c: c < F.col("_x")))
                                           + F.array_contains("_cuts", F.col("_x")).cast("int")).alias("_b")))
    names = [f"_c{i}" for i in range(buckets)]
    daily = binned.groupBy(*node, "_d").agg(*[F.count_if(F.col("_b") <= i).alias(n) for i, n in enumerate(names)])
    cal = daily.withColumn("_t", F.lit(False)).unionByName(ask.select(*node, F.col("_td").alias("_d")).distinct().select(
        "*", F.lit(True).alias("_t"), *[F.lit(0).cast("long").alias(n) for n in names]))
    # rows up to each bucket in the trailing days: those of all days before less those of the days before the frame, since a
    # frame that only grows takes each day once
    upto = lambda n, day: F.coalesce(F.sum(n).over(Window.partitionBy(*node).orderBy("_d").rangeBetween(
        Window.unboundedPreceding, -day)), F.lit(0))
    sums = cal.select(*node, F.col("_d").alias("_td"), "_t", *[(upto(n, 1) - upto(n, days + 1)).alias(n) for n in names]) \
        .where("_t").select(*node, "_td", F.array(*names).alias("_s"))
    asked = ask.join(sums, [*node, "_td"]).withColumn("_n", F.coalesce("_n", F.get("_s", F.lit(buckets - 1)))).where("_n > 0")
    half = (F.col("_n") - 1).cast("double") * F.lit(5e-1)
    asked = asked.withColumn("_pos", F.explode(F.when(F.col("_pos").isNull(), F.array(
        F.struct(F.lit(0).alias("hi"), F.floor(half).alias("at")), F.struct(F.lit(1).alias("hi"), F.ceil(half).alias("at"))))
        .otherwise(F.array("_pos")))).withColumn("_to", _middle(F.col("_pos.at"), F.col("_s")))
    below = binned.withColumn("_p", F.col("_p") * buckets + F.col("_b")).drop("_b")
    span = below.groupBy(*node).agg(F.min("_x").alias("_least"), F.max("_x").alias("_most"), F.count(F.lit(1)).alias("_rows"))
    asked = asked.select("_r", "_m", "_td", "_n", (F.col("_p") * buckets + F.col("_to.b")).alias("_p"),
                         F.struct(F.col("_pos.hi").alias("hi"), (F.col("_pos.at") - F.col("_to.cum")).alias("at")).alias("_pos"))
    return below, materialize(asked.join(span, node))


def rolling_route_medians(targets: DataFrame, history: DataFrame | None = None, route_col: str = "route",
                          days: int = WINDOW_DAYS, cuts=ROOT_CUTS, leaf: int = MEDIAN_LEAF) -> DataFrame:
    """Add the trailing ``days``-day median of history time / cost on the same route,
    excluding the target's own day (NULL when there is no history), to every target row.

    ``history`` = None means the targets are their own history (they then carry the
    time / cost columns).  All rows of one (route, day) share the same frame, so medians are
    taken per distinct (route, day) and equi-joined back, from a tree of value counts:

    1. a sketch per route cuts its values into buckets (any cut gives the same result), and
       rows are counted per (route, day, bucket), one row a day;
    2. a window over calendar days, not over history rows, sums the trailing days; the sums
       name the bucket of each middle rank and the rank inside it;
    3. a bucket that holds a single value answers at once; one of more than ``leaf`` rows is
       cut again like a route of its own (a level further down, as often as it takes);
    4. only what is left, buckets of at most ``leaf`` rows, is read and ranked.
    """
    hist = targets if history is None else history
    km = ["_r", "_m"]
    vals = hist.where(F.col(route_col).isNotNull() & F.col("ship_date").isNotNull()).select(
        F.col(route_col).alias("_r"), _epoch_day(F.col("ship_date")).alias("_d"), F.explode(F.array(
            F.struct(F.lit("time").alias("m"), F.col(TIME).cast("double").alias("x")),
            F.struct(F.lit("cost").alias("m"), F.col(COST).cast("double").alias("x")))).alias("_v")) \
        .select("_r", "_d", F.col("_v.m").alias("_m"), F.col("_v.x").alias("_x"), F.lit(0).cast("long").alias("_p")).where(F.col("_x").isNotNull())
    ask = targets.where(F.col(route_col).isNotNull() & F.col("ship_date").isNotNull()).select(
        F.col(route_col).alias("_r"), _epoch_day(F.col("ship_date")).alias("_td")).distinct().select(
        "*", F.explode(F.array(F.lit("time"), F.lit("cost"))).alias("_m"), F.lit(0).cast("long").alias("_p"), F.lit(None).cast("long").alias("_n"),
        F.lit(None).cast("struct<hi:int,at:long>").alias("_pos"))
    answers = []
    while True:
        vals, asked = _level(vals, ask, days, cuts)
        cuts = NODE_CUTS
        one = F.col("_least") == F.col("_most")
        answers.append(asked.where(one).select(*km, "_td", "_n", F.col("_pos.hi").alias("_hi"), F.col("_least").alias("_x")))
        open_ = asked.where(~one)
        nodes = open_.groupBy(*km, "_p").agg(F.max("_rows").alias("_rows"))
        vals = vals.join(nodes, [*km, "_p"])
        if (nodes.agg(F.max("_rows")).first()[0] or 0) <= leaf:
            break
        # small buckets are ranked now, large ones go down a level
        answers.append(_ranked(vals.where(F.col("_rows") <= leaf), open_.where(F.col("_rows") <= leaf), days))
        vals = vals.where(F.col("_rows") > leaf).drop("_rows")
        ask = open_.where(F.col("_rows") > leaf).select(*km, "_p", "_td", "_n", "_pos")
    answers.append(_ranked(vals, open_, days))
    mid = answers[0]
    for more in answers[1:]:
        mid = mid.unionByName(more)
    mid = mid.groupBy(*km, "_td").agg(F.max("_n").alias("_n"), *[F.max(F.when(F.col("_hi") == k, F.col("_x"))).alias(n) for k, n in ((0, "_xl"), (1, "_xh"))])
    half = (F.col("_n") - 1).cast("double") * F.lit(5e-1)
    part = half - F.floor(half)
    mid = mid.withColumn("_med", F.col("_xl") * (F.lit(1e0) - part) + F.col("_xh") * part)
    med = mid.groupBy("_r", "_td").agg(*[F.max(F.when(F.col("_m") == t, F.col("_med"))).alias(f"route_30d_median_{t}")
                                         for t in ("time", "cost")])
    med = med.select(F.col("_r").alias(route_col), F.date_add(F.lit("1970-01-01").cast("date"), F.col("_td").cast("int")).alias("ship_date"),
                     "route_30d_median_time", "route_30d_median_cost")
    # a row per route and day, written: the join knows its size before it moves any target row
    return targets.join(materialize(med), [route_col, "ship_date"], "left")


def _ranked(vals: DataFrame, asked: DataFrame, days: int) -> DataFrame:
    """Read the asked nodes' values in each frame and rank them: (_r, _m, _td, _n, _hi, _x)."""
    node = ["_r", "_m", "_p"]
    ranks = asked.groupBy(*node, "_td", "_n").agg(F.collect_list("_pos").alias("_want")).withColumn(  # one or two ranks
        "_blk", F.floor(F.col("_td") / days))
    # a day's values serve targets of its own block of days and of the next
    near = vals.drop("_rows").withColumn("_blk", F.explode(F.array(F.floor(F.col("_d") / days), F.floor(F.col("_d") / days) + 1))) \
        .join(ranks, [*node, "_blk"]).where((F.col("_td") - F.col("_d")).between(1, days))
    w = Window.partitionBy(*node, "_td").orderBy("_x")
    return near.withColumn("_rank", F.row_number().over(w) - 1).select("_r", "_m", "_td", "_n", "_x", F.explode(F.filter(
        "_want", lambda t: t["at"] == F.col("_rank"))).alias("_t")).select("_r", "_m", "_td", "_n", F.col("_t.hi").alias("_hi"), "_x")


def _global_medians(s: DataFrame) -> DataFrame:
    return percentiles_multi(s, [], [(TIME, [0.5], ["_gt"]), (COST, [0.5], ["_gc"])])


def with_route_medians(rows: DataFrame, fallback_from: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Rolling route medians with the global-median fallback (one-row broadcast)."""
    med = rolling_route_medians(rows, history)
    g = _global_medians(fallback_from)
    return med.crossJoin(F.broadcast(g)).withColumn(
        "route_30d_median_time", F.coalesce("route_30d_median_time", "_gt")).withColumn(
        "route_30d_median_cost", F.coalesce("route_30d_median_cost", "_gc")).drop("_gt", "_gc")


def route_median_table(history: DataFrame, days: int = WINDOW_DAYS) -> tuple[DataFrame, DataFrame]:
    """M4 as a table: (route, ship_date, trailing medians) for every day a route has a frame on, its last
    one included, and the one row of global medians (``_gt``, ``_gc``)."""
    s = materialize(history)
    h = materialize(with_keys(s).select("route", "ship_date", TIME, COST))
    served = h.where("route IS NOT NULL AND ship_date IS NOT NULL").select("route", "ship_date").distinct().select(
        "route", F.explode(F.sequence(F.date_add("ship_date", 1), F.date_add("ship_date", days))).alias("ship_date")).distinct()
    return rolling_route_medians(served, h, days=days), _global_medians(s)


def with_stored_medians(rows: DataFrame, medians: tuple[DataFrame, DataFrame]) -> DataFrame:
    """The medians of :func:`route_median_table` joined to rows of (route, ship_date); a route without a
    frame on that day gets the global ones (one-row broadcast)."""
    known, overall = medians
    out = rows.join(known, ["route", "ship_date"], "left").crossJoin(F.broadcast(overall))
    return out.withColumn("route_30d_median_time", F.coalesce("route_30d_median_time", "_gt")).withColumn(
        "route_30d_median_cost", F.coalesce("route_30d_median_cost", "_gc")).drop("_gt", "_gc")


def route_30d_median(s: DataFrame, train_only: bool = False) -> DataFrame:
    """M3: trailing 30-day route medians of time and cost; a row without history gets the
    global median of all rows (``train_only``: of the train split)."""
    s = materialize(s)
    ks = with_keys(s).select("l_orderkey", "l_linenumber", "route", "ship_date", TIME, COST)
    out = with_route_medians(ks, train_rows(s) if train_only else s)
    return out.select("l_orderkey", "l_linenumber", "route", "ship_date",
                      r6("route_30d_median_time").alias("route_30d_median_time"),
                      r6("route_30d_median_cost").alias("route_30d_median_cost"))


def request_history_features(req: DataFrame, s: DataFrame, as_of: str = AS_OF_DATE) -> DataFrame:
    """M4: trailing 30-day medians on route 'z->z' from the shipment history for every request.

    An undated request is dated ``as_of`` (P19); a route without history in its window, a
    zone outside 1..9 among them, gets the global history medians.  ``reason`` names what
    was wrong with the request ('' when nothing).
    """
    zone = F.col("zone")
    q = req.select("request_id", "l_linenumber", sc.route_key(zone, zone).alias("route"),
                   F.concat_ws(";", F.when(F.col("ship_date").isNull(), F.lit("missing:ship_date")),
                               F.when(zone.isNull() | ~zone.between(1, 9), F.lit("range:zone"))).alias("reason"),
                   sc.default_ship_date(F.col("ship_date"), as_of).alias("ship_date"))
    s = materialize(s)
    hist = with_keys(s).select("route", "ship_date", TIME, COST)
    out = with_route_medians(q, s, hist)
    return out.select("request_id", "l_linenumber", "route", "ship_date", "reason",
                      r6("route_30d_median_time").alias("route_30d_median_time"),
                      r6("route_30d_median_cost").alias("route_30d_median_cost"))


# ---------------------------------------------------------------------- M6
# fixed values: the model's features, in order
TIME_FEATURES = ["dow_sin", "dow_cos", "month_sin", "month_cos", "package_weight_lbs", "package_volume",
                 "dimensional_weight", "billable_weight", "weight_to_volume_ratio", "route_30d_median_time",
                 "route_te_time", "origin_zone_te_time", "dest_zone_te_time", "carrier_te_time",
                 "service_level_te_time", "origin_service_te_time", "carrier_service_te_time"]
COST_FEATURES = [f.replace("_time", "_cost") for f in TIME_FEATURES]
# fixed values: what the zones-only model sees, calendar, route history and encodings, no package
ZONE_FEATURES = ["dow_sin", "dow_cos", "month_sin", "month_cos", "route_30d_median_time", "route_te_time", "origin_zone_te_time",
                 "dest_zone_te_time", "carrier_te_time", "service_level_te_time", "origin_service_te_time", "carrier_service_te_time"]
FEATURES = {"time": TIME_FEATURES, "cost": COST_FEATURES, "zones": ZONE_FEATURES}


def feature_table(s: DataFrame) -> DataFrame:
    """All model inputs per row: calendar/cyclical, package, rolling medians, encodings, split."""
    s = materialize(s)
    ks = materialize(with_keys(time_split(s)))
    ks = ks.select("*", F.weekday("ship_date").alias("dow"), F.month("ship_date").alias("month"))
    ks = ks.select("*", *sc.cyclical(F.col("dow"), 7, "dow"), *sc.cyclical(F.col("month"), 12, "month"),
                   *sc.package_columns())
    x = with_route_medians(ks, s)
    enc = encodings(ks.where(F.col("split") == "train"), 200, 20)    # the medians add columns, no rows
    return apply_encodings(x, enc)


def feature_matrix(s: DataFrame, model: str = "time") -> DataFrame:
    """M6: the ordered features of the time, cost (17) or zones-only (12) model, target and split."""
    f = feature_table(s)
    return f.select("l_orderkey", "l_linenumber", "split", *[r6(c).alias(c) for c in FEATURES[model]],
                    F.col(LABELS[model]).alias("label"))


def feature_matrix_time(s: DataFrame) -> DataFrame:
    return feature_matrix(s, "time")


def feature_matrix_cost(s: DataFrame) -> DataFrame:
    return feature_matrix(s, "cost")


def feature_matrix_zones(s: DataFrame) -> DataFrame:
    return feature_matrix(s, "zones")


# --------------------------------------------------------------------- M13
def zone_only_features(req: DataFrame, enc: DataFrame, history: DataFrame | None = None,
                       medians: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """M13 core: serving features of requests that carry one ``zone``: route 'z->z',
    origin = dest = z, encodings with prior fallback.

    With a shipment ``history``, or its stored ``medians`` (:func:`route_median_table`), the rolling
    medians are those of M4 (an undated request is dated by P19, a route without history gets the
    global medians); without, they are the fixed serving values.
    """
    q = req.select("*", sc.route_key(F.col("zone"), F.col("zone")).alias("route"),
                   F.col("zone").alias("origin_zone"), F.col("zone").alias("dest_zone"),
                   F.concat(F.col("zone").cast("string"), F.lit("::"), F.col("service_level")).alias("origin_service"),
                   F.concat(F.col("carrier"), F.lit("::"), F.col("service_level")).alias("carrier_service"),
                   F.weekday("ship_date").alias("dow"), F.month("ship_date").alias("month"))
    q = q.select("*", *sc.cyclical(F.col("dow"), 7, "dow"), *sc.cyclical(F.col("month"), 12, "month"),
                 *sc.package_columns())
    if medians is not None:
        q = with_stored_medians(q.withColumn("ship_date", sc.default_ship_date(F.col("ship_date"), AS_OF_DATE)), medians)
    elif history is None:
        q = q.select("*", F.lit(rd.ZONE_ONLY_MEDIAN_TIME).alias("route_30d_median_time"),
                     F.lit(rd.ZONE_ONLY_MEDIAN_COST).alias("route_30d_median_cost"))
    else:
        history = materialize(history)
        q = q.withColumn("ship_date", sc.default_ship_date(F.col("ship_date"), AS_OF_DATE))
        q = with_route_medians(q, history, with_keys(history).select("route", "ship_date", TIME, COST))
    return apply_encodings(q, enc)


def serving_features_zone_only(req: DataFrame, s: DataFrame) -> DataFrame:
    """M13 query: zone-only serving features for every request (train-fitted encodings)."""
    enc = encodings(with_keys(train_rows(s)), 200, 20)
    f = zone_only_features(req, enc)
    cols = sorted(set(TIME_FEATURES + COST_FEATURES))
    return f.select("request_id", "l_linenumber", *[r6(c).alias(c) for c in cols])


# --------------------------------------------------------------------- M14
def carrier_quotes(req: DataFrame, sort_by: str = "cost") -> DataFrame:
    """Every request quoted for each of the fixed carriers with the rate-card scorer
    (P11/P12), ranked by cost (or time), ties by carrier name; rank 1 = best option.

    The quotes are computed side by side in one row and ranked arithmetically, then
    exploded: no join and no window over requests.
    """
    spark = req.sparkSession
    carriers = rd.QUOTE_CARRIERS
    base = req.select("request_id", "l_linenumber", "ship_date", "service_level",
                      F.col("zone").alias("rate_zone"), *sc.package_columns(), F.month("ship_date").alias("month"))
    rc = F.broadcast(sc.rate_card_table(spark).select(F.col("service_level").alias("_s"),
                                                     F.col("rate_zone").alias("_z"), "base_days", "base_cost"))
    b = base.join(rc, (F.col("service_level") == F.col("_s")) & (F.col("rate_zone") == F.col("_z")), "left")
    # the quotes once, as columns; the ranking below only references them
    b = b.select("request_id", "l_linenumber", *[
        e for i, c in enumerate(carriers) for e in (
            sc.expected_transit(F.col("base_days"), F.lit(rd.CARRIER_DAYS_OFFSET.get(c, 0.0))).alias(f"_d{i}"),
            sc.expected_cost(F.col("base_cost"), F.lit(rd.CARRIER_COST_MULT.get(c, 1.0))).alias(f"_c{i}"))])
    key = (lambda i: F.col(f"_c{i}")) if sort_by == "cost" else (lambda i: F.col(f"_d{i}"))
    structs = []
    for i, c in enumerate(carriers):
        better = F.lit(0)
        for j, c2 in enumerate(carriers):
            if i == j:
                continue
            k1, k2 = key(i), key(j)
            # the other quote ranks ahead when its score is lower, or equal with a smaller name
            ahead = (k2 < k1) | ((k2 == k1) & F.lit(c2 < c)) | (k1.isNull() & k2.isNotNull()) | \
                (k1.isNull() & k2.isNull() & F.lit(c2 < c))
            better = better + F.when(ahead, 1).otherwise(0)
        structs.append(F.struct(F.lit(c).alias("carrier"), F.col(f"_d{i}").alias("expected_transit_days"),
                                F.col(f"_c{i}").alias("expected_cost_usd"), (better + 1).alias("rank")))
    x = b.select("request_id", "l_linenumber", F.explode(F.array(*structs)).alias("_q"))
    return x.select("request_id", "l_linenumber", "_q.carrier", r6("_q.expected_transit_days").alias(
        "expected_transit_days"), r6("_q.expected_cost_usd").alias("expected_cost_usd"),
        F.col("_q.rank").cast("int").alias("rank"), (F.col("_q.rank") == 1).alias("is_best"))
