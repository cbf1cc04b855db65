"""Row-level rule queries (P1-P4, P7-P15, P19): projections and broadcast lookups.

All of them are map-only over the fact rows (no shuffle) except where a
dimension join is needed; the dimensions (1,000 ZIP prefixes, 36 rate-card
cells, 8 carriers, 5 service specs) have a fixed size and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.functions import scalars as sc
from shiplens.functions.stats import COST, TIME, cnt, r6
from shiplens.sources import tables as tb

KEY = ["l_orderkey", "l_linenumber"]


def calendar_features(s: DataFrame) -> DataFrame:
    """Weekday (Mon=0), month, day of year, quarter, day name."""
    return s.select(*KEY, "ship_date", *sc.calendar_columns("ship_date"))


def cyclical_features(s: DataFrame) -> DataFrame:
    """sin/cos of weekday/7 and month/12."""
    x = s.select(*KEY, "ship_date", F.weekday("ship_date").alias("dow"), F.month("ship_date").alias("month"))
    x = x.select(*KEY, "ship_date", *sc.cyclical(F.col("dow"), 7, "dow"),
                 *sc.cyclical(F.col("month"), 12, "month"))
    return x.select(*KEY, "ship_date",
                    *[r6(n).alias(n) for n in ("dow_sin", "dow_cos", "month_sin", "month_cos")])


def route_keys(s: DataFrame) -> DataFrame:
    """P3: 'o->d', 'o::service', 'carrier::service'."""
    return s.select(*KEY, *sc.route_columns())


def package_features(s: DataFrame) -> DataFrame:
    """Volume, dimensional weight (vol/166), billable weight, weight/(vol+1)."""
    x = s.select(*KEY, *sc.package_columns())
    return x.select(*KEY, *[r6(c).alias(c) for c in x.columns if c not in KEY])


def zip_zone_lookup(lanes: DataFrame, chart: str = "utils") -> DataFrame:
    """ZIP -> zone for both ends of every lane; a non-numeric prefix gives NULL and a
    reason (the reference raises)."""
    x = sc.with_zip_zone(lanes, "origin_zip", "origin_zone", chart)
    x = sc.with_zip_zone(x, "dest_zip", "dest_zone", chart)
    bad = F.concat_ws(";", F.when(sc.zip_prefix("origin_zip").isNull(), F.lit("bad:origin_zip")),
                      F.when(sc.zip_prefix("dest_zip").isNull(), F.lit("bad:dest_zip")))
    return x.select("o_orderkey", "origin_zip", "origin_zone", "dest_zip", "dest_zone", bad.alias("reasons"))


def zip_lane_zone(lanes: DataFrame, chart: str = "utils") -> DataFrame:
    """Zone distance |zone(o) - zone(d)| and rate zone clamp(distance + 1, 1, 9)."""
    z = zip_zone_lookup(lanes, chart)
    d = sc.zone_distance("origin_zone", "dest_zone")
    return z.select("o_orderkey", "origin_zone", "dest_zone", d.alias("zone_distance"),
                    sc.rate_zone(d).alias("rate_zone"))


def _requests_with_rates(req: DataFrame) -> DataFrame:
    x = req.select("request_id", "l_linenumber", "ship_date", "carrier", "service_level",
                   F.col("zone").alias("rate_zone"), "package_weight_lbs", "package_length_in",
                   "package_width_in", "package_height_in")
    return sc.with_rate_card(x)


def rate_card_lookup(req: DataFrame) -> DataFrame:
    """P10: base days and base cost by (service, rate zone); unknown cells NULL."""
    x = _requests_with_rates(req)
    return x.select("request_id", "l_linenumber", "service_level", "rate_zone", "base_days", "base_cost")


def expected_transit(req: DataFrame) -> DataFrame:
    """Base days + carrier offset (0 for unknown carriers), clamped 1..30, 1 decimal."""
    x = _requests_with_rates(req)
    return x.select("request_id", "l_linenumber", "carrier", "service_level", "rate_zone",
                    r6(sc.expected_transit()).alias("expected_transit_days"))


def expected_cost(req: DataFrame) -> DataFrame:
    """Base x carrier multiplier (1 for unknown) x billable-weight factor x fuel factor of
    the month; floor 3.00; 2 decimals."""
    x = _requests_with_rates(req)
    x = x.select("*", *sc.package_columns(), F.month("ship_date").alias("month"))
    return x.select("request_id", "l_linenumber", "carrier", "service_level", "rate_zone",
                    r6(sc.expected_cost()).alias("expected_cost_usd"))


def distance_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance category of every shipment from region-coded endpoints
    ('<REGION>_<NATION>' of supplier and customer), counted per category."""
    t = lambda n: tb.table(spark, sf_dir, n)
    nat = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    code = nat.select("n_nationkey", F.concat(F.col("r_name"), F.lit("_"), F.col("n_name")).alias("code"))
    sup = t("supplier").join(F.broadcast(code), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("code").alias("origin_code"))
    cus = t("customer").join(F.broadcast(code), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("code").alias("dest_code"))
    o = t("orders").select("o_orderkey", "o_custkey").join(cus, F.col("o_custkey") == F.col("c_custkey"))
    l = t("lineitem").select("l_orderkey", "l_suppkey")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.groupBy(sc.distance_category(F.col("origin_code"), F.col("dest_code")).alias("distance_category")
                     ).agg(cnt().alias("n"))


def zone_labels(s: DataFrame) -> DataFrame:
    """P9: 'Zone_k' labels parsed back to k, counted per parsed zone."""
    lab = F.concat(F.lit("Zone_"), F.col("origin_zone").cast("string"))
    return s.groupBy(sc.zone_label_number(lab).alias("zone")).agg(cnt().alias("n"))


def linear_rate_model(s: DataFrame) -> DataFrame:
    """Deterministic part of the linear rate model per shipment (random terms excluded)."""
    spark = s.sparkSession
    spec = F.broadcast(sc.service_spec_table(spark).withColumnRenamed("service_level", "_svc"))
    adj = F.broadcast(sc.carrier_adjustment_table(spark).withColumnRenamed("carrier", "_car")
                      .withColumnRenamed("cost_mult", "_cm"))
    x = (s.select(*KEY, "carrier", "service_level", "dest_zone", "package_weight_lbs", "package_volume_cubic_in",
                  TIME, COST)
         .join(spec, F.col("service_level") == F.col("_svc"), "left")
         .join(adj, F.col("carrier") == F.col("_car"), "left"))
    return x.select(*KEY, "carrier", "service_level", "dest_zone", TIME, COST,
                    sc.linear_days("base_time", "zone_factor", "dest_zone", "time_mult").alias("model_days"),
                    sc.linear_cost("base_cost", "zone_factor", "dest_zone", "package_weight_lbs",
                                   "package_volume_cubic_in", "_cm").alias("model_cost"))


def linear_rate_model_q(s: DataFrame) -> DataFrame:
    x = linear_rate_model(s)
    return x.select(*KEY, r6("model_days").alias("model_days"), r6("model_cost").alias("model_cost"))


def rate_residuals(s: DataFrame) -> DataFrame:
    """Observed minus modelled (P14) days and cost: mean and mean absolute residual by
    carrier x service."""
    x = linear_rate_model(s)
    rd_, rc_ = F.col(TIME) - F.col("model_days"), F.col(COST) - F.col("model_cost")
    g = x.groupBy("carrier", "service_level").agg(
        cnt().alias("n"), F.avg(rd_).alias("mean_days_residual"), F.avg(F.abs(rd_)).alias("mae_days"),
        F.avg(rc_).alias("mean_cost_residual"), F.avg(F.abs(rc_)).alias("mae_cost"))
    return g.select("carrier", "service_level", "n", *[r6(c).alias(c) for c in (
        "mean_days_residual", "mae_days", "mean_cost_residual", "mae_cost")])


AS_OF_DATE = "2024-06-30"


def default_ship_date(req: DataFrame, as_of: str = AS_OF_DATE) -> DataFrame:
    """A request without a ship date is dated ``as_of`` (explicit, not the wall clock)."""
    return req.select("request_id", "l_linenumber", sc.default_ship_date(F.col("ship_date"), as_of)
                      .alias("ship_date"), F.col("ship_date").isNull().alias("date_defaulted"))
