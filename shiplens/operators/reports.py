"""Business-intelligence reports.

Every report is one or two partial-aggregating shuffles over the fact rows;
second-level statistics (quantiles of group counts, trends over months,
shares) run on the aggregated rows.  Dense grids (months x services, zones x
zones) are products of the distinct key values, never of fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions.quantiles import null_safe_join, percentiles, percentiles_multi, percentiles_of_metrics
from shiplens.functions.scalars import day_name, package_category, weight_bins
from shiplens.functions.stats import COST, TIME, cnt, exact_avg, r6, r9
from shiplens.session import materialize, materialize_small
from shiplens.sources.tables import union_all

SIZE_CATEGORIES = ["Small", "Medium", "Large", "XLarge"]


def _mean_std_count(prefix: str, col: str, count: bool = False):
    out = [exact_avg(col).alias(f"{prefix}_mean"), F.stddev_samp(col).alias(f"{prefix}_std")]
    if count:
        out.append(cnt(col).alias(f"{prefix}_count"))
    return out


def _round_all(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, *[r6(c).alias(c) if not c.endswith("_count") and c != "n" else F.col(c)
                              for c in df.columns if c not in keep])


def _time_cost_pattern(s: DataFrame, key) -> DataFrame:
    g = s.groupBy(key).agg(*_mean_std_count(TIME, TIME, count=True), *_mean_std_count(COST, COST))
    return _round_all(g, [g.columns[0]])


def dow_pattern(s: DataFrame) -> DataFrame:
    """By day name: transit mean/std/count, cost mean/std."""
    return _time_cost_pattern(s, day_name(F.col("ship_date")).alias("day_of_week"))


def monthly_pattern(s: DataFrame) -> DataFrame:
    """By calendar month (years pooled)."""
    return _time_cost_pattern(s, F.month("ship_date").alias("month"))


def _share(s: DataFrame, row, col, row_name: str, col_name: str, pct: bool) -> DataFrame:
    """Cross-tab in long form with zeros: (row, col, count[, share % of row])."""
    c = s.groupBy(row.alias(row_name), col.alias(col_name)).agg(cnt().alias("n"))
    rows = c.select(row_name).distinct()
    cols = c.select(col_name).distinct()
    grid = rows.crossJoin(F.broadcast(cols))  # distinct keys only: tiny x tiny
    out = null_safe_join(grid, c, [row_name, col_name], "left").fillna(0, ["n"])
    if not pct:
        return out.withColumnRenamed("n", "count")
    tot = F.sum("n").over(Window.partitionBy(row_name))
    return out.select(row_name, col_name, r6(F.col("n") / tot * F.lit(1e2)).alias("share_pct"))


def service_trends(s: DataFrame) -> DataFrame:
    """Service-level share (%) of each month's shipments, zeros included."""
    return _share(s, F.month("ship_date"), F.col("service_level"), "month", "service_level", True)


def flow_matrix(s: DataFrame) -> DataFrame:
    """Shipment counts origin zone x destination zone, zeros included."""
    return _share(s, F.col("origin_zone"), F.col("dest_zone"), "origin_zone", "dest_zone", False)


def carrier_dominance(s: DataFrame) -> DataFrame:
    """Carrier share (%) of each destination zone."""
    return _share(s, F.col("dest_zone"), F.col("carrier"), "dest_zone", "carrier", True)


def distance_performance(s: DataFrame) -> DataFrame:
    """By zone distance |dest - origin|: time and cost mean/std, count; flags the most
    common distance (ties: smallest distance)."""
    g = s.groupBy(F.abs(F.col("dest_zone") - F.col("origin_zone")).alias("zone_distance")).agg(
        *_mean_std_count(TIME, TIME), *_mean_std_count(COST, COST), cnt().alias("n"))
    top = F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("zone_distance")))
    g = g.withColumn("is_most_common", top == 1)  # window over <= 9 aggregated rows
    return _round_all(g, ["zone_distance", "is_most_common"])


def size_impact(s: DataFrame) -> DataFrame:
    """By package size category (volume bins, right-closed): time mean/std, cost
    mean/std/median, count; empty categories kept with count 0."""
    x = materialize(s.select(package_category(F.col("package_volume_cubic_in")).alias("package_category"), TIME, COST
                             ).where(F.col("package_category").isNotNull()))
    g = x.groupBy("package_category").agg(*_mean_std_count(TIME, TIME), *_mean_std_count(COST, COST),
                                          cnt().alias("n"))
    med = percentiles(x, ["package_category"], COST, [0.5], [f"{COST}_median"])
    g = null_safe_join(g, med, ["package_category"], "left")
    cats = s.sparkSession.createDataFrame([(c, i) for i, c in enumerate(SIZE_CATEGORIES)],
                                          "package_category string, _o int")
    out = null_safe_join(F.broadcast(cats), g, ["package_category"], "left").fillna(0, ["n"]).drop("_o")
    return _round_all(out, ["package_category"])


def weight_impact(s: DataFrame, bins: int = 10) -> DataFrame:
    """By equal-width weight bin (10 bins, right-closed, first widened by 0.1% of the
    range): cost and time mean/std; label 'left-right' (1 decimal) is display only."""
    # one-row range, materialised: the binning pass and the label grid share one scan
    rng = materialize_small(s.agg(F.min("package_weight_lbs").alias("_mn"), F.max("package_weight_lbs").alias("_mx")))
    x = s.select("package_weight_lbs", TIME, COST).crossJoin(F.broadcast(rng))  # 1-row side
    x = x.withColumn("bin", weight_bins(F.col("package_weight_lbs"), F.col("_mn"), F.col("_mx"), bins))
    g = x.groupBy("bin").agg(*_mean_std_count(COST, COST), *_mean_std_count(TIME, TIME),
                             cnt().alias("n"))
    grid = rng.select("_mn", "_mx", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    w = (F.col("_mx") - F.col("_mn")) / F.lit(float(bins))
    left = F.when(F.col("bin") == 1, F.col("_mn") - (F.col("_mx") - F.col("_mn")) * F.lit(1e-3)) \
        .otherwise(F.col("_mn") + (F.col("bin") - 1) * w)
    right = F.when(F.col("bin") == bins, F.col("_mx")).otherwise(F.col("_mn") + F.col("bin") * w)
    r1 = lambda c: F.round(c * F.lit(1e1)) / F.lit(1e1)
    grid = grid.select("bin", F.concat(r1(left).cast("string"), F.lit("-"), r1(right).cast("string"))
                       .alias("weight_range"))
    out = null_safe_join(grid, g, ["bin"], "left").fillna(0, ["n"])
    return _round_all(out, ["bin", "weight_range"])


def value_comparison(s: DataFrame) -> DataFrame:
    """Insured value > 500 (high) vs <= 500 (regular): count, mean time, mean cost."""
    band = F.when(F.col("insurance_value") > 500, "high_value").when(
        F.col("insurance_value") <= 500, "regular_value")
    g = s.groupBy(band.alias("value_band")).agg(cnt().alias("n"), exact_avg(TIME).alias("avg_transit"),
                                                exact_avg(COST).alias("avg_cost"))
    return _round_all(g.where(F.col("value_band").isNotNull()), ["value_band"])


def value_service_counts(s: DataFrame) -> DataFrame:
    """Service-level frequency within each insured-value band."""
    band = F.when(F.col("insurance_value") > 500, "high_value").when(
        F.col("insurance_value") <= 500, "regular_value")
    return (s.groupBy(band.alias("value_band"), "service_level").agg(cnt().alias("n"))
            .where(F.col("value_band").isNotNull()))


def _scorecard(s: DataFrame, key: str, count: bool) -> DataFrame:
    extra = [cnt().alias("n")] if count else []
    s = materialize(s.select(key, TIME, COST))          # two passes, one evaluation
    g = s.groupBy(key).agg(*_mean_std_count(TIME, TIME), *_mean_std_count(COST, COST), *extra)
    med = percentiles_multi(s, [key], [(TIME, [0.5], [f"{TIME}_median"]), (COST, [0.5], [f"{COST}_median"])])
    out = null_safe_join(g, med, [key])
    return _round_all(out, [key])


def carrier_scorecard(s: DataFrame) -> DataFrame:
    """By carrier: time and cost mean/std/median, count."""
    return _scorecard(s, "carrier", True)


def carrier_consistency(s: DataFrame) -> DataFrame:
    """Coefficient of variation of transit time per carrier."""
    g = s.groupBy("carrier").agg((F.stddev_samp(TIME) / exact_avg(TIME)).alias("consistency_index"))
    return _round_all(g, ["carrier"])


def service_effectiveness(s: DataFrame) -> DataFrame:
    """By service level: time and cost mean/std/median."""
    return _scorecard(s, "service_level", False)


def cost_efficiency(s: DataFrame) -> DataFrame:
    """Mean of per-row cost per transit day by carrier x service (0 days -> NULL)."""
    g = s.groupBy("carrier", "service_level").agg(
        F.avg(F.try_divide(F.col(COST), F.col(TIME))).alias("cost_per_day"))
    return _round_all(g, ["carrier", "service_level"])


LANE_FEATURES = [COST, TIME, "package_weight_lbs", "insurance_value"]


def lane_profile(s: DataFrame) -> DataFrame:
    """Per lane (origin zone, destination zone): mean cost, time, weight, insurance."""
    return _lane_means(s).select("origin_zone", "dest_zone", *[r6(c).alias(c) for c in LANE_FEATURES], "n")


def _lane_means(s: DataFrame) -> DataFrame:
    return s.groupBy("origin_zone", "dest_zone").agg(*[exact_avg(c).alias(c) for c in LANE_FEATURES],
                                                     cnt().alias("n"))


def lane_zscores(s: DataFrame) -> DataFrame:
    """Lane features standardised with the population std over lanes."""
    lp = _lane_means(s)
    st = lp.agg(*[F.avg(c).alias(f"_m_{c}") for c in LANE_FEATURES],
                *[F.stddev_pop(c).alias(f"_s_{c}") for c in LANE_FEATURES])
    z = lp.crossJoin(F.broadcast(st))  # one-row statistics
    return z.select("origin_zone", "dest_zone", *[
        r6((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).alias(f"z_{c}") for c in LANE_FEATURES])


def iqr_outliers(s: DataFrame, examples: int = 10) -> DataFrame:
    """Per target: Q1, Q3, fences, count and % of rows outside Q1-1.5 IQR / Q3+1.5 IQR,
    and the ``examples`` most extreme outliers (largest distance beyond a fence)."""
    if not getattr(s, "_shiplens_materialized", False):
        s = materialize(s.select(TIME, COST))            # several passes, one evaluation
    long = s.select(F.explode(F.array(
        F.struct(F.lit("transit_time").alias("metric"), F.col(TIME).alias("v")),
        F.struct(F.lit("shipping_cost").alias("metric"), F.col(COST).alias("v")))).alias("_m")
    ).select("_m.metric", "_m.v")
    q = materialize(percentiles_of_metrics(s, [], "metric", {"transit_time": TIME, "shipping_cost": COST}, [0.25, 0.75], ["q1", "q3"]))
    q = q.select("metric", "q1", "q3",
                 (F.col("q1") - F.lit(1.5e0) * (F.col("q3") - F.col("q1"))).alias("lower_fence"),
                 (F.col("q3") + F.lit(1.5e0) * (F.col("q3") - F.col("q1"))).alias("upper_fence"))
    j = long.join(F.broadcast(q), "metric")  # two rows
    out_flag = (F.col("v") < F.col("lower_fence")) | (F.col("v") > F.col("upper_fence"))
    agg = j.groupBy("metric").agg(cnt().alias("n"), F.sum(F.when(out_flag, 1).otherwise(0)).cast("long")
                                  .alias("outlier_count"))
    excess = F.greatest(F.col("lower_fence") - F.col("v"), F.col("v") - F.col("upper_fence"))
    outl = j.where(out_flag).select("metric", "v", excess.alias("excess"))
    # top-k per metric: TakeOrderedAndProject keeps k rows per task, then merges
    tops = union_all([outl.where(F.col("metric") == m).orderBy(F.col("excess").desc(), F.col("v").desc())
                      .limit(examples) for m in ("transit_time", "shipping_cost")])
    ex = tops.groupBy("metric").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(-F.col("excess"), -F.col("v"), F.col("v")))),
        lambda t: (F.round(t.getField("v") * F.lit(1e6)) / F.lit(1e6)).cast("string")), ",").alias("examples"))
    res = q.join(agg, "metric").join(ex, "metric", "left")
    return res.select("metric", r9("q1").alias("q1"), r9("q3").alias("q3"),
                      r9("lower_fence").alias("lower_fence"), r9("upper_fence").alias("upper_fence"),
                      "outlier_count", r6(F.col("outlier_count") / F.col("n") * F.lit(1e2)).alias("outlier_pct"),
                      "examples")


def rare_combinations(s: DataFrame) -> DataFrame:
    """Carrier x service combinations whose count is below the 10% quantile of counts."""
    c = materialize(s.groupBy("carrier", "service_level").agg(cnt().alias("n")))
    thr = percentiles(c, [], "n", [0.1], ["threshold"])
    return (c.crossJoin(F.broadcast(thr)).where(F.col("n") < F.col("threshold"))
            .select("carrier", "service_level", "n", r6("threshold").alias("threshold")))


def _daily(s: DataFrame) -> DataFrame:
    d = materialize(s.groupBy("ship_date").agg(cnt().alias("volume")))
    thr = percentiles(d, [], "volume", [0.9], ["threshold"])
    return d.crossJoin(F.broadcast(thr))


def capacity_insights(s: DataFrame) -> DataFrame:
    """Mean daily volume, its 90% quantile and the number of days strictly above it."""
    d = _daily(s)
    return d.agg(r6(F.avg("volume")).alias("avg_daily_volume"), r6(F.max("threshold")).alias("peak_threshold"),
                 F.sum(F.when(F.col("volume") > F.col("threshold"), 1).otherwise(0)).cast("long")
                 .alias("stress_days"), cnt().alias("active_days"))


def peak_days(s: DataFrame) -> DataFrame:
    """The days whose volume is strictly above the 90% quantile of daily volumes."""
    d = _daily(s)
    return d.where(F.col("volume") > F.col("threshold")).select("ship_date", "volume")


def performance_trend(s: DataFrame) -> DataFrame:
    """Mean transit per month, OLS slope over the month positions 0..n-1; risk High
    if slope > 0.1; trend Declining if slope >= 0."""
    m = s.groupBy(F.month("ship_date").alias("month")).agg(exact_avg(TIME).alias("mean_transit"))
    pos = F.row_number().over(Window.orderBy("month")) - 1  # <= 12 aggregated rows
    m = m.withColumn("pos", pos.cast("double"))
    t = m.agg(F.regr_slope("mean_transit", "pos").alias("slope"), cnt().alias("months"))
    return t.select(r6("slope").alias("trend_slope"), "months",
                    F.when(F.col("slope") > F.lit(1e-1), "High").otherwise("Low").alias("degradation_risk"),
                    F.when(F.col("slope") < 0, "Improving").otherwise("Declining").alias("trend"))


def cheapest_by_zone(s: DataFrame) -> DataFrame:
    """Per destination zone: cheapest and dearest carrier by mean cost and the gap
    (ties: alphabetical)."""
    g = s.groupBy("dest_zone", "carrier").agg(exact_avg(COST).alias("mean_cost"))
    lo = F.row_number().over(Window.partitionBy("dest_zone").orderBy("mean_cost", "carrier"))
    hi = F.row_number().over(Window.partitionBy("dest_zone").orderBy(F.col("mean_cost").desc(), "carrier"))
    g = g.select("*", lo.alias("_lo"), hi.alias("_hi"))
    out = g.groupBy(F.col("dest_zone").alias("zone")).agg(
        F.max(F.when(F.col("_lo") == 1, F.col("carrier"))).alias("cheapest_carrier"),
        F.max(F.when(F.col("_hi") == 1, F.col("carrier"))).alias("most_expensive_carrier"),
        F.max(F.when(F.col("_lo") == 1, F.col("mean_cost"))).alias("_c"),
        F.max(F.when(F.col("_hi") == 1, F.col("mean_cost"))).alias("_e"))
    return out.select("zone", "cheapest_carrier", "most_expensive_carrier",
                      r6(F.col("_e") - F.col("_c")).alias("potential_savings"))


def _top_routes(df: DataFrame, o: str, d: str, k: int) -> DataFrame:
    route = F.concat_ws("->", F.col(o).cast("string"), F.col(d).cast("string"))
    return (df.groupBy(route.alias("route")).agg(cnt().alias("n"))
            .orderBy(F.col("n").desc(), F.col("route")).limit(k))


def top_routes(s: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent zone routes 'o->d' (ties by name)."""
    return _top_routes(s, "origin_zone", "dest_zone", k)


def top_zip_routes(lanes: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent ZIP routes."""
    return _top_routes(lanes, "origin_zip", "dest_zip", k)


def top_shipping_days(s: DataFrame, k: int = 3) -> DataFrame:
    """The k weekdays with most shipments."""
    return (s.groupBy(day_name(F.col("ship_date")).alias("day_of_week")).agg(cnt().alias("n"))
            .orderBy(F.col("n").desc(), "day_of_week").limit(k))


def comprehensive_report(s: DataFrame) -> DataFrame:
    """Headline figures of the reports as one long table (section, metric, key, value).

    The narrow projection the sections share is written once, so the fact join is
    computed once for all sections and nothing stays persisted.
    """
    from shiplens.operators.models import segment_summary
    base = materialize(s.select("ship_date", "carrier", *dict.fromkeys(["origin_zone", "dest_zone", "insurance_value", TIME, COST, *LANE_FEATURES])))
    dbl = lambda c: F.col(c).cast("double")
    days = top_shipping_days(base).select(F.lit("temporal").alias("section"),
                                          F.lit("top_shipping_day").alias("metric"),
                                          F.col("day_of_week").alias("key"), dbl("n").alias("value"))
    dist = distance_performance(base).where("is_most_common").select(
        F.lit("geographic").alias("section"), F.lit("most_common_distance").alias("metric"),
        F.col("zone_distance").cast("string").alias("key"), dbl("n").alias("value"))
    val = value_comparison(base).select(F.lit("package").alias("section"),
                                        F.concat("value_band", F.lit("_count")).alias("metric"),
                                        F.lit(None).cast("string").alias("key"), dbl("n").alias("value"))
    fast = (base.groupBy("carrier").agg(exact_avg(TIME).alias("m"))
            .agg(F.min_by("carrier", F.struct("m", "carrier")).alias("key"), F.min("m").alias("value"))
            .select(F.lit("performance").alias("section"), F.lit("fastest_carrier").alias("metric"),
                    "key", r6("value").alias("value")))
    io = iqr_outliers(base).where(F.col("metric") == "transit_time")
    outl = union_all([
        io.select(F.lit("anomalies").alias("section"), F.lit("transit_outliers").alias("metric"),
                  F.lit(None).cast("string").alias("key"), dbl("outlier_count").alias("value")),
        io.select(F.lit("anomalies").alias("section"), F.lit("transit_outlier_pct").alias("metric"),
                  F.lit(None).cast("string").alias("key"), dbl("outlier_pct").alias("value"))])
    seg = segment_summary(base).select("segment", "lanes")
    segm = union_all([
        seg.agg(cnt().alias("n")).select(F.lit("segmentation").alias("section"), F.lit("segments").alias("metric"),
                                         F.lit(None).cast("string").alias("key"), dbl("n").alias("value")),
        seg.select(F.lit("segmentation").alias("section"), F.lit("zone_pairs").alias("metric"),
                   F.col("segment").cast("string").alias("key"), dbl("lanes").alias("value"))])
    tr = performance_trend(base)
    trend = union_all([
        tr.select(F.lit("insights").alias("section"), F.lit("trend_slope").alias("metric"),
                  F.col("trend").alias("key"), F.col("trend_slope").alias("value")),
        tr.select(F.lit("insights").alias("section"), F.lit("degradation_risk").alias("metric"),
                  F.col("degradation_risk").alias("key"), F.col("trend_slope").alias("value"))])
    return union_all([days, dist, val, fast, segm, outl, trend])
