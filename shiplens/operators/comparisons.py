"""Service / carrier comparisons and winner selection.

Winners are picked with ``min_by(payload, struct(score, name))``: ties go to
the alphabetically first name, and the pick is a mergeable aggregate.  All
windows / picks run over aggregated cells (hundreds of rows), never over
fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions.quantiles import null_safe_join, percentiles
from shiplens.functions.stats import COST, TIME, cnt, exact_avg, r6
from shiplens.operators.summaries import percentile_filtered
from shiplens.session import materialize

METRICS = {"transit_time_days": TIME, "shipping_cost_usd": COST}


def _zones(s: DataFrame, zones: Sequence[int] | None) -> DataFrame:
    return s if zones is None else s.where(F.col("dest_zone").isin([int(z) for z in zones]))


def _pick(score, name, payload=None):
    """min_by over (score, name): NULL scores never win."""
    payload = name if payload is None else payload
    return F.min_by(payload, F.when(score.isNotNull(), F.struct(score, name)))


def compare_services_2sigma(s: DataFrame, zones: Sequence[int] | None = None) -> DataFrame:
    """Per zone x service: mean, std, mean +/- 2s, 4s, 95% CI of the mean; zone winner
    = lowest upper 2-sigma bound."""
    g = _zones(s, zones).groupBy(F.col("dest_zone").alias("zone"), "service_level").agg(
        cnt().alias("n"), exact_avg(TIME).alias("mean"), F.stddev_samp(TIME).alias("std"))
    m, sd = F.col("mean"), F.col("std")
    half = F.lit(1.96e0) * sd / F.sqrt(F.col("n"))
    g = g.select("zone", "service_level", "n", "mean", "std",
                 (m - F.lit(2e0) * sd).alias("lower_2sigma"), (m + F.lit(2e0) * sd).alias("upper_2sigma"),
                 (F.lit(4e0) * sd).alias("range_2sigma"), (m - half).alias("ci95_low"),
                 (m + half).alias("ci95_high"))
    win = g.groupBy("zone").agg(_pick(F.col("upper_2sigma"), F.col("service_level")).alias("winner"))
    out = g.join(F.broadcast(win), "zone", "left")
    return out.select("zone", "service_level", "n",
                      *[r6(c).alias(c) for c in ("mean", "std", "lower_2sigma", "upper_2sigma",
                                                   "range_2sigma", "ci95_low", "ci95_high")],
                      (F.col("winner") == F.col("service_level")).alias("is_winner"))


def _carrier_stats(s: DataFrame, zones, metric: str) -> DataFrame:
    """E9 core (unrounded): per zone x service x carrier with more than 5 rows."""
    col = METRICS[metric]
    keys = ["zone", "service_level", "carrier"]
    base = materialize(_zones(s, zones).select(F.col("dest_zone").alias("zone"), "service_level", "carrier",
                                               F.col(col).alias("v")))   # two passes, one evaluation
    g = base.groupBy(*keys).agg(cnt("v").alias("sample_size"), exact_avg("v").alias("mean"),
                                F.stddev_samp("v").alias("std")).where(F.col("sample_size") > 5)
    qs = percentiles(base, keys, "v", [0.5, 0.25, 0.75], ["median", "q25", "q75"])
    out = materialize(null_safe_join(g, qs, keys))       # a row a cell, read by several winners
    return out.select(*keys, "sample_size", "mean", "median", "std", "q25", "q75",
                      (F.col("mean") - F.lit(2e0) * F.col("std")).alias("lower_2sigma"),
                      (F.col("mean") + F.lit(2e0) * F.col("std")).alias("upper_2sigma"),
                      (F.lit(1e0) / (F.col("std") + F.lit(1e-1))).alias("reliability_score"))


def compare_carriers(s: DataFrame, zones: Sequence[int] | None = None,
                     metric: str = "transit_time_days") -> DataFrame:
    """Carrier comparison inside each zone x service (cells with n > 5)."""
    c = _carrier_stats(s, zones, metric)
    return c.select("zone", "service_level", "carrier", "sample_size",
                    *[r6(x).alias(x) for x in ("mean", "median", "std", "q25", "q75", "lower_2sigma",
                                               "upper_2sigma", "reliability_score")])


def carrier_winners(s: DataFrame, zones: Sequence[int] | None = None,
                    metric: str = "transit_time_days") -> DataFrame:
    """Per zone x service: lowest-median carrier and lowest-upper-2-sigma carrier, with
    their values and advantage over the carriers' average."""
    return _cell_winners(_carrier_stats(s, zones, metric))


def _cell_winners(c: DataFrame) -> DataFrame:
    """E10 from the cells of :func:`_carrier_stats`."""
    car = F.col("carrier")
    g = c.groupBy("zone", "service_level").agg(
        F.count(F.lit(1)).alias("carriers_compared"),
        _pick(F.col("median"), car).alias("winner_median"),
        _pick(F.col("median"), car, F.col("median")).alias("winner_median_value"),
        F.avg("median").alias("_avg_median"),
        _pick(F.col("upper_2sigma"), car).alias("winner_2sigma"),
        _pick(F.col("upper_2sigma"), car, F.col("upper_2sigma")).alias("winner_2sigma_value"),
        _pick(F.col("upper_2sigma"), car, F.col("median")).alias("winner_2sigma_median"),
        _pick(F.col("upper_2sigma"), car, F.col("std")).alias("winner_2sigma_std"),
        F.avg("upper_2sigma").alias("_avg_upper"))
    return g.select(
        "zone", "service_level", F.col("carriers_compared").cast("long").alias("carriers_compared"),
        "winner_median", r6("winner_median_value").alias("winner_median_value"),
        r6(F.col("_avg_median") - F.col("winner_median_value")).alias("winner_median_advantage"),
        "winner_2sigma", r6("winner_2sigma_value").alias("winner_2sigma_value"),
        r6("winner_2sigma_median").alias("winner_2sigma_median"),
        r6("winner_2sigma_std").alias("winner_2sigma_std"),
        r6(F.col("_avg_upper") - F.col("winner_2sigma_value")).alias("winner_2sigma_advantage"),
        F.col("winner_median").alias("winner"))


def zone_overall_winners(s: DataFrame, zones: Sequence[int] | None = None,
                         metric: str = "transit_time_days") -> DataFrame:
    """Per zone, the (carrier, service) with the lowest median / reliability and the one
    with the lowest upper 2-sigma bound."""
    return _zone_winners(_carrier_stats(s, zones, metric))


def _zone_winners(c: DataFrame) -> DataFrame:
    """E11 from the cells of :func:`_carrier_stats`."""
    c = c.where(
        F.col("median").isNotNull() & F.col("upper_2sigma").isNotNull()
        & F.col("reliability_score").isNotNull())
    score = F.col("median") / F.col("reliability_score")
    name = F.struct(F.col("carrier"), F.col("service_level"))
    up = F.col("upper_2sigma")
    g = c.groupBy("zone").agg(
        F.min_by(F.col("carrier"), F.struct(score, name)).alias("median_carrier"),
        F.min_by(F.col("service_level"), F.struct(score, name)).alias("median_service_level"),
        F.min_by(F.col("median"), F.struct(score, name)).alias("median_value"),
        F.min_by(F.col("reliability_score"), F.struct(score, name)).alias("median_reliability"),
        F.min_by(F.col("carrier"), F.struct(up, name)).alias("sigma_carrier"),
        F.min_by(F.col("service_level"), F.struct(up, name)).alias("sigma_service_level"),
        F.min_by(up, F.struct(up, name)).alias("sigma_upper_2sigma"),
        F.min_by(F.col("median"), F.struct(up, name)).alias("sigma_median"),
        F.min_by(F.col("std"), F.struct(up, name)).alias("sigma_std"))
    return g.select("zone", "median_carrier", "median_service_level",
                    *[r6(x).alias(x) for x in ("median_value", "median_reliability")],
                    "sigma_carrier", "sigma_service_level",
                    *[r6(x).alias(x) for x in ("sigma_upper_2sigma", "sigma_median", "sigma_std")])


def carrier_win_tally(s: DataFrame, zones: Sequence[int] | None = None,
                      metric: str = "transit_time_days") -> DataFrame:
    """Wins per carrier (cell wins and zone wins, by median and by 2-sigma) and per
    carrier x service; ``is_top`` marks the most frequent winner of each kind."""
    c = _carrier_stats(s, zones, metric)                 # the cells once for both kinds of winners
    cw, zw = _cell_winners(c), _zone_winners(c)
    wins = (cw.select(F.lit("cell_median").alias("kind"), F.col("winner_median").alias("carrier"),
                      F.lit(None).cast("string").alias("service_level"))
            .unionByName(cw.select(F.lit("cell_2sigma").alias("kind"), F.col("winner_2sigma").alias("carrier"),
                                   F.lit(None).cast("string").alias("service_level")))
            .unionByName(zw.select(F.lit("zone_median").alias("kind"), F.col("median_carrier").alias("carrier"),
                                   F.lit(None).cast("string").alias("service_level")))
            .unionByName(zw.select(F.lit("zone_2sigma").alias("kind"), F.col("sigma_carrier").alias("carrier"),
                                   F.lit(None).cast("string").alias("service_level")))
            .unionByName(cw.select(F.lit("combo_median").alias("kind"), F.col("winner_median").alias("carrier"),
                                   "service_level"))
            .unionByName(cw.select(F.lit("combo_2sigma").alias("kind"), F.col("winner_2sigma").alias("carrier"),
                                   "service_level")))
    t = wins.groupBy("kind", "carrier", "service_level").agg(cnt().alias("wins"))
    w = Window.partitionBy("kind").orderBy(F.col("wins").desc(), F.col("carrier"),
                                           F.col("service_level").asc_nulls_first())
    return t.withColumn("is_top", F.row_number().over(w) == 1)


def best_service_percentile(s: DataFrame, percentile: float = 80, method: str = "median",
                            zones: Sequence[int] | None = None) -> DataFrame:
    """Per zone x service: metric of the rows at or under the p-th percentile of transit
    time; winner = lowest metric in the zone."""
    if not 0 <= percentile <= 100:
        raise ValueError("percentile must be within 0..100")
    pf = percentile_filtered(_zones(s, zones), [percentile], [method],
                             keys=["dest_zone", "service_level"])
    pf = pf.select(F.col("dest_zone").alias("zone"), "service_level",
                   F.col("median_transit_time").alias("metric_value"), "percentile_threshold",
                   "records_in_percentile", "total_shipments", "percentile_coverage", "method")
    win = pf.groupBy("zone").agg(_pick(F.col("metric_value"), F.col("service_level")).alias("winner"))
    return pf.join(F.broadcast(win), "zone", "left").select(
        *pf.columns, (F.col("winner") == F.col("service_level")).alias("is_winner"))


def carrier_grid_2sigma(s: DataFrame, percentile: float = 50, method: str = "median") -> DataFrame:
    """P20: display band over the E4 grid: lower = max(0, m - 2s), upper = m + 2s of the chosen
    transit metric m; winner per service x zone = lowest m."""
    pf = percentile_filtered(s, [percentile], [method])
    m, sd = F.col("median_transit_time"), F.col("transit_time_std")
    g = pf.select("carrier", "service_level", F.col("dest_zone").alias("zone"),
                  m.alias("metric_value"), sd.alias("std"),
                  F.greatest(F.lit(0e0), m - F.lit(2e0) * sd).alias("lower"),
                  (m + F.lit(2e0) * sd).alias("upper"))
    win = g.groupBy("service_level", "zone").agg(
        _pick(F.col("metric_value"), F.col("carrier")).alias("winner"))
    return g.join(F.broadcast(win), ["service_level", "zone"], "left").select(
        "carrier", "service_level", "zone", "metric_value", "std", r6("lower").alias("lower"),
        r6("upper").alias("upper"), (F.col("winner") == F.col("carrier")).alias("is_winner"))
