"""Distribution statistics, normality tests and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions.quantiles import null_safe_join, percentiles_of_metrics
from shiplens.functions.stats import COST, TIME, cnt, exact_avg, normal_quantile, normal_upper, polynomial, r6, r9
from shiplens.session import materialize, materialize_small

METRIC_NAMES = {"transit_time": TIME, "shipping_cost": COST}
DIST_PROBS = [0.25, 0.75, 0.5, 0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99]
DIST_NAMES = ["q25", "q75", "median", "p10", "p20", "p30", "p40", "p60", "p70", "p80", "p90",
              "p95", "p99"]
CELL = ["service_level", "zone", "metric"]


def metric_long(s: DataFrame, metrics: Sequence[str] = ("transit_time", "shipping_cost")) -> DataFrame:
    """(service_level, zone, metric, v): one row per fact row and metric."""
    return s.select("service_level", F.col("dest_zone").alias("zone"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(METRIC_NAMES[m]).alias("v")) for m in metrics
    ])).alias("_m")).select("service_level", "zone", "_m.metric", "_m.v")


def _filter(s: DataFrame, service_level=None, zone=None) -> DataFrame:
    if service_level is not None:
        s = s.where(F.col("service_level") == service_level)
    if zone is not None:
        s = s.where(F.col("dest_zone") == int(zone))
    return s


def distribution_stats(s: DataFrame, service_level: str | None = None, zone: int | None = None,
                       metric: str | None = None) -> DataFrame:
    """E5: full distribution profile per (service, zone, metric); parameters filter.

    skewness / kurtosis are the population (biased) moments, kurtosis in
    excess form, as Spark's built-ins compute them.
    """
    metrics = [metric] if metric else ["transit_time", "shipping_cost"]
    s = materialize(_filter(s, service_level, zone).select("service_level", "dest_zone", *[METRIC_NAMES[m] for m in metrics]))
    long = metric_long(s, metrics)
    g = long.groupBy(*CELL).agg(
        cnt("v").alias("count"), exact_avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.var_samp("v").alias("var"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.skewness("v").alias("skewness"), F.kurtosis("v").alias("kurtosis"))
    qs = percentiles_of_metrics(s, ["service_level", F.col("dest_zone").alias("zone")], "metric", {m: METRIC_NAMES[m] for m in metrics},
                                DIST_PROBS, DIST_NAMES)
    out = null_safe_join(g, qs, CELL)
    out = out.withColumn("iqr", F.col("q75") - F.col("q25"))
    floats = ["mean", "std", "var", "min", "max", "skewness", "kurtosis"]
    order_stats = ["median", "q25", "q75", "iqr"] + [n for n in DIST_NAMES if n.startswith("p")]
    return out.select(*CELL, "count", *[r6(c).alias(c) for c in floats],
                      *[r9(c).alias(c) for c in order_stats])


def all_distributions(s: DataFrame) -> DataFrame:
    """E5 on the dense service x zone(1..9) x metric grid; empty cells are NULL."""
    spark = s.sparkSession
    s = materialize(s.select("service_level", "dest_zone", TIME, COST))  # the grid's services and the figures
    services = s.select("service_level").distinct()
    zones = spark.range(1, 10).select(F.col("id").cast("int").alias("zone"))
    metrics = spark.createDataFrame([("transit_time",), ("shipping_cost",)], "metric string")
    # the grid is (#services x 9 x 2) rows: a product of three tiny dimension tables
    grid = services.crossJoin(F.broadcast(zones)).crossJoin(F.broadcast(metrics))
    stats = distribution_stats(s)
    return null_safe_join(grid, stats, CELL, "left")


def jarque_bera(s: DataFrame) -> DataFrame:
    """Jarque-Bera normality test on all rows per (service, zone, metric).

    JB = n/6 (S^2 + K^2/4) with population skewness S and excess kurtosis K;
    p = exp(-JB/2) (chi-square, 2 degrees of freedom).
    """
    long = metric_long(s)
    g = long.groupBy(*CELL).agg(cnt("v").alias("n"), F.skewness("v").alias("S"),
                                F.kurtosis("v").alias("K"))
    jb = F.col("n") / F.lit(6e0) * (F.col("S") * F.col("S") + F.col("K") * F.col("K") / F.lit(4e0))
    return g.select(*CELL, "n", r6(jb).alias("jb_statistic"), r6(F.exp(-jb / F.lit(2e0))).alias("jb_p_value"),
                    (F.exp(-jb / F.lit(2e0)) > F.lit(5e-2)).alias("is_normal_p05"))


# ------------------------------------------------------------------ Shapiro-Wilk
SW_SAMPLE = 5000
# AS R94 polynomial coefficients (Royston 1995) of the last two weights and of the
# transformed statistic's mean and logarithmic deviation, for 4..11 values and for 12 or more.
SW_LAST = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
SW_SECOND = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SW_GAMMA = [-2.273, 0.459]
SW_SMALL = ([0.5440, -0.39978, 0.025054, -0.0006714], [1.3822, -0.77857, 0.062767, -0.0020322])
SW_LARGE = ([-1.5861, -0.31082, -0.083751, 0.0038915], [-0.4803, -0.082676, 0.0030302])


def shapiro_wilk(s: DataFrame, sample: int = SW_SAMPLE) -> DataFrame:
    """Shapiro-Wilk on a deterministic sample of <= ``sample`` rows per group, as aggregates.

    The sample is the ``sample`` rows with the smallest md5 of order, line and metric.  A
    Bernoulli pre-filter on that hash, with a rate sized from the group count plus a wide binomial
    margin, shrinks every group to about ``sample`` rows before the per-group window.  Ranks give
    each value its normal score; W follows from sums over scores and values and from the two
    values at either end, so no group is handed to Python.  Groups of fewer than three values,
    or of equal ones, have no W.
    """
    key = F.md5(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("metric")))
    long = s.select("l_orderkey", "l_linenumber", "service_level", F.col("dest_zone").alias("zone"), F.explode(
        F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("v"))
                  for m, c in METRIC_NAMES.items()])).alias("_m")
    ).select("service_level", "zone", "_m.metric", "_m.v", "l_orderkey", "l_linenumber").where("v IS NOT NULL") \
        .select(*CELL, "v", key.alias("_h"))
    u = F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))
    n = long.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"))
    rate = F.least(F.lit(1.0), (F.lit(float(sample)) + F.lit(8.0) * F.sqrt(F.lit(float(sample))) + F.lit(64.0)) / F.col("_n"))
    group = Window.partitionBy(*CELL)
    taken = null_safe_join(long, n, CELL).where(u < rate).withColumn("_k", F.row_number().over(group.orderBy("_h", "v"))) \
        .where(F.col("_k") <= sample)
    ranked = taken.select(*CELL, "v", F.row_number().over(group.orderBy("v", "_h")).alias("i"), F.count(F.lit(1)).over(group).alias("n")) \
        .withColumn("p", (F.col("i") - F.lit(0.375)) / (F.col("n") + F.lit(0.25))).withColumn("m", F.expr(normal_quantile("p")))
    at = lambda k, c: F.max(F.when(F.col("i") == k, F.col(c)))
    g = ranked.groupBy(*CELL).agg(
        F.max("n").alias("n"), F.sum(F.col("m") * F.col("v")).alias("mx"), F.sum(F.col("m") * F.col("m")).alias("mm"),
        at(F.col("n"), "m").alias("mn"), at(F.col("n") - 1, "m").alias("mn1"), (at(F.col("n"), "v") - at(F.lit(1), "v")).alias("d1"),
        (at(F.col("n") - 1, "v") - at(F.lit(2), "v")).alias("d2"), (F.var_pop("v") * F.count("v")).alias("ss"))
    u_ = "(1e0 / sqrt(n))"
    g = g.withColumn("an", F.expr(f"mn / nullif(sqrt(mm), 0e0) + {polynomial(SW_LAST, u_)}")).withColumn("an1", F.expr(f"mn1 / nullif(sqrt(mm), 0e0) + {polynomial(SW_SECOND, u_)}"))
    line = F.expr("""CASE WHEN n < 3 THEN NULL WHEN n = 3 THEN sqrt(0.5e0) * d1
        WHEN n <= 5 THEN (mx - mn * d1) / sqrt((mm - 2 * mn * mn) / (1 - 2 * an * an)) + an * d1
        ELSE (mx - mn * d1 - mn1 * d2) / sqrt((mm - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * an * an - 2 * an1 * an1)) + an * d1 + an1 * d2 END""")
    g = g.withColumn("w", F.when((F.col("n") >= 3) & (F.col("d1") > 0), F.least(F.lit(1.0), line * line / F.col("ss"))))
    few, many = (f"({y} - {polynomial(c[0], x)}) / exp({polynomial(c[1], x)})" for y, x, c in (
        (f"-ln({polynomial(SW_GAMMA, 'n')} - ln(1 - w))", "n", SW_SMALL), ("ln(1 - w)", "ln(n)", SW_LARGE)))
    g = g.withColumn("z", F.expr(f"CASE WHEN w IS NULL OR w >= 1 THEN NULL WHEN n <= 11 THEN {few} ELSE {many} END"))
    p = F.expr(f"""CASE WHEN w IS NULL THEN NULL WHEN n = 3 THEN least(1e0, greatest(0e0, 6 / pi() * (asin(sqrt(w)) - asin(sqrt(0.75e0)))))
        WHEN w >= 1 THEN 1e0 WHEN n <= 11 AND {polynomial(SW_GAMMA, 'n')} - ln(1 - w) <= 0 THEN 0e0 ELSE {normal_upper('z')} END""")
    g = g.withColumn("_p", p)
    return g.select(*CELL, F.col("n").cast("long").alias("n_sample"), r6("w").alias("shapiro_wilk_statistic"), r6("_p").alias("shapiro_wilk_p_value"),
                    F.coalesce(F.col("_p") > 0.05, F.lit(False)).alias("is_normal_p05"))


def histogram(s: DataFrame, service_level: str = "STANDARD", zone: int = 5,
              metric: str = "transit_time", bins: int = 30) -> DataFrame:
    """Equal-width histogram of one cell (bins 10..100).

    Bin k (1-based) covers [lo + (k-1)w, lo + kw), the last bin also holds
    max; lo/hi are min/max, widened by 0.5 each side when min = max.  Empty
    bins are returned with count 0.
    """
    if not 1 <= bins <= 1000:
        raise ValueError("bins out of range")
    cell = _filter(s, service_level, zone).select(F.col(METRIC_NAMES[metric]).alias("v"))
    return _histograms(cell, [], bins)


def histogram_all_cells(s: DataFrame, metric: str = "transit_time", bins: int = 30) -> DataFrame:
    """E14 for every service x zone in one job (per-group edges)."""
    cells = s.select("service_level", F.col("dest_zone").alias("zone"),
                     F.col(METRIC_NAMES[metric]).alias("v"))
    return _histograms(cells, ["service_level", "zone"], bins)


def _histograms(df: DataFrame, keys: list[str], bins: int) -> DataFrame:
    df = df.where(F.col("v").isNotNull())
    rng = df.groupBy(*keys).agg(F.min("v").alias("_mn"), F.max("v").alias("_mx"),
                                cnt().alias("total_count"))
    same = F.col("_mn") == F.col("_mx")
    rng = rng.select(*keys, "total_count",
                     F.when(same, F.col("_mn") - F.lit(5e-1)).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(same, F.col("_mx") + F.lit(5e-1)).otherwise(F.col("_mx")).alias("_hi"))
    rng = rng.withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    # one row per cell: materialised so the counting pass and the bin grid share one scan
    rng = materialize_small(rng)
    b = F.least(F.floor((F.col("v") - F.col("_lo")) / F.col("_w")).cast("int") + 1, F.lit(bins))
    counts = (null_safe_join(df, rng, keys) if keys else df.crossJoin(F.broadcast(rng)))
    counts = counts.groupBy(*keys, b.alias("bin")).agg(cnt().alias("count"))
    grid = rng.select(*keys, "total_count", "_lo", "_w",
                      F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = null_safe_join(grid, counts, keys + ["bin"], "left")
    return out.select(*keys, "bin",
                      r6(F.col("_lo") + (F.col("bin") - F.lit(5e-1)) * F.col("_w")).alias("bin_center"),
                      F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count"),
                      r6("_w").alias("bin_width"), "total_count")
