"""Data quality and dataset profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions import refdata as rd
from shiplens.functions.quantiles import null_safe_join, percentiles_of_metrics
from shiplens.functions.stats import cnt, exact_avg, r6, sorted_list
from shiplens.session import materialize


def validation_reasons() -> Column:
    """';'-joined list of violated request rules ('' when valid), in schema order."""
    parts = [F.when(F.col(f).isNull(), F.lit(f"missing:{f}")) for f in rd.REQUEST_REQUIRED]
    for f, (lo, hi) in rd.REQUEST_RANGES.items():
        parts.append(F.when((F.col(f) < lo) | (F.col(f) > hi), F.lit(f"range:{f}")))
    parts.append(F.when(~F.col("carrier").isin(rd.REQUEST_CARRIERS), F.lit("enum:carrier")))
    parts.append(F.when(~F.col("service_level").isin(rd.REQUEST_SERVICES), F.lit("enum:service_level")))
    return F.concat_ws(";", *parts)


def request_validation(req: DataFrame) -> DataFrame:
    """Every request with ``valid`` and the list of violated rules."""
    x = req.withColumn("reasons", validation_reasons())
    return x.select("request_id", "l_linenumber", (F.col("reasons") == "").alias("valid"), "reasons")


def split_valid(req: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A6 sinks: (valid requests, rejected requests with reasons)."""
    x = req.withColumn("reasons", validation_reasons())
    return x.where(F.col("reasons") == "").drop("reasons"), x.where(F.col("reasons") != "")


def drop_missing_targets(raw: DataFrame) -> DataFrame:
    """Rows with both targets and a ship date."""
    return raw.dropna(subset=["transit_time_raw", "shipping_cost_raw", "ship_date"]).select(
        "l_orderkey", "l_linenumber", "ship_date", "carrier", "service_level", "dest_zone",
        "transit_time_raw", "shipping_cost_raw")


def dataset_profile(raw: DataFrame) -> DataFrame:
    """Rows, date range, distinct keys, missing targets (one aggregate pass)."""
    return raw.agg(
        cnt().alias("total_rows"), F.min("ship_date").alias("min_date"), F.max("ship_date").alias("max_date"),
        F.countDistinct("carrier").cast("long").alias("carriers"),
        F.countDistinct("service_level").cast("long").alias("service_levels"),
        F.countDistinct("origin_zone").cast("long").alias("origin_zones"),
        F.countDistinct("dest_zone").cast("long").alias("dest_zones"),
        F.count_if(F.col("transit_time_raw").isNull()).cast("long").alias("missing_transit_time"),
        F.count_if(F.col("shipping_cost_raw").isNull()).cast("long").alias("missing_shipping_cost"))


DESCRIBE_COLUMNS = ["transit_time_raw", "shipping_cost_raw", "package_weight_lbs",
                    "package_volume_cubic_in", "insurance_value"]


def describe_targets(raw: DataFrame) -> DataFrame:
    """Count, mean, std, min, 25/50/75%, max per numeric column (NULLs skipped)."""
    raw = materialize(raw.select(*[F.col(c).cast("double").alias(c) for c in DESCRIBE_COLUMNS]))   # two passes, one evaluation
    long = raw.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in DESCRIBE_COLUMNS
    ])).alias("_c")).select("_c.column", "_c.v")
    g = long.groupBy("column").agg(cnt("v").alias("count"), exact_avg("v").alias("mean"),
                                   F.stddev_samp("v").alias("std"), F.min("v").alias("min"),
                                   F.max("v").alias("max"))
    q = percentiles_of_metrics(raw, [], "column", {c: c for c in DESCRIBE_COLUMNS}, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    out = null_safe_join(g, q, ["column"])
    return out.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "p25", "p50",
                                                                     "p75", "max")])


def service_value_counts(s: DataFrame) -> DataFrame:
    """Shipments per service level."""
    return s.groupBy("service_level").agg(cnt().alias("n"))


def zone_value_counts(s: DataFrame) -> DataFrame:
    """Shipments per destination zone (ordered by zone)."""
    return s.groupBy(F.col("dest_zone").alias("zone")).agg(cnt().alias("n")).orderBy("zone")


def training_profile(s: DataFrame) -> DataFrame:
    """Total rows, sorted carriers / services / zones, date range, column count."""
    return s.agg(cnt().alias("total_shipments"), sorted_list(F.col("carrier")).alias("carriers"),
                 sorted_list(F.col("service_level")).alias("service_levels"),
                 sorted_list(F.col("dest_zone")).alias("zones_covered"),
                 F.min("ship_date").alias("min_date"), F.max("ship_date").alias("max_date"),
                 F.lit(len(s.columns)).cast("long").alias("features_count"))
