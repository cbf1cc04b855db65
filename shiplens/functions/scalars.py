"""Column-level rules (P1-P19): pure expressions, kept inside whole-stage codegen.

Lookups against fixed dimensions (ZIP prefix -> zone, rate cards) are
broadcast joins against tables of a proven, constant size (1,000 prefixes,
36 rate-card cells, 8 carriers).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.functions import refdata as rd


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# P1 ---------------------------------------------------------------- calendar
def day_name(d) -> Column:
    """Full English day name ('Monday')."""
    return F.date_format(_c(d), "EEEE")


def calendar_columns(d="ship_date") -> list[Column]:
    d = _c(d)
    return [F.weekday(d).alias("dow"), F.month(d).alias("month"), F.dayofyear(d).alias("day_of_year"),
            F.quarter(d).alias("quarter"), day_name(d).alias("day_of_week")]


# P2 --------------------------------------------------------------- cyclical
def cyclical(x, period: float, name: str) -> list[Column]:
    rad = F.lit(2e0) * F.lit(math.pi) * _c(x) / F.lit(float(period))
    return [F.sin(rad).alias(f"{name}_sin"), F.cos(rad).alias(f"{name}_cos")]


# P3 ----------------------------------------------------------- route keys
def route_key(o="origin_zone", d="dest_zone") -> Column:
    return F.concat(_c(o).cast("string"), F.lit("->"), _c(d).cast("string"))


def route_columns() -> list[Column]:
    return [route_key().alias("route"),
            F.concat(F.col("origin_zone").cast("string"), F.lit("::"), F.col("service_level")).alias("origin_service"),
            F.concat(F.col("carrier"), F.lit("::"), F.col("service_level")).alias("carrier_service")]


# P4 ------------------------------------------------------ package features
def package_columns(weight="package_weight_lbs", length="package_length_in", width="package_width_in",
                    height="package_height_in") -> list[Column]:
    w = _c(weight)
    vol = _c(length) * _c(width) * _c(height)
    dim = vol / F.lit(rd.DIM_FACTOR)
    # np.maximum propagates a missing operand; greatest() would skip it
    billable = F.when(w.isNull() | dim.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(w, dim))
    return [vol.alias("package_volume"), dim.alias("dimensional_weight"), billable.alias("billable_weight"),
            (w / (vol + F.lit(1e0))).alias("weight_to_volume_ratio")]


# P5 ---------------------------------------------------------------------
def zone_distance(o="origin_zone", d="dest_zone") -> Column:
    return F.abs(_c(d) - _c(o))



# P7 / P8 ---------------------------------------------------- ZIP -> zone
def zip_prefix(z) -> Column:
    """First three characters as an integer; NULL when not numeric."""
    return F.expr(f"try_cast(substr({z}, 1, 3) AS INT)") if isinstance(z, str) else \
        F.substring(z, 1, 3).try_cast("int")


def prefix_zone_table(spark: SparkSession, chart: str = "utils") -> DataFrame:
    """1,000-row dimension (prefix, zone) flattened from the interval chart."""
    return spark.createDataFrame(rd.prefix_zone_rows(chart), "prefix int, zone int")


def with_zip_zone(df: DataFrame, zip_col: str, out: str, chart: str = "utils") -> DataFrame:
    """Add ``out`` = zone of ``zip_col`` (broadcast equi-join on the 3-digit prefix)."""
    dim = F.broadcast(prefix_zone_table(df.sparkSession, chart).select(
        F.col("prefix").alias(f"_{out}_p"), F.col("zone").alias(out)))
    x = df.withColumn(f"_{out}_k", zip_prefix(zip_col))
    x = x.join(dim, x[f"_{out}_k"] == dim[f"_{out}_p"], "left")
    # a numeric prefix outside 0..999 falls back to the default zone, like an unmatched one
    z = F.when(F.col(f"_{out}_k").isNull(), F.lit(None).cast("int")).otherwise(
        F.coalesce(F.col(out), F.lit(rd.DEFAULT_ZIP_ZONE)))
    return x.withColumn(out, z).drop(f"_{out}_k", f"_{out}_p")


def rate_zone(dist) -> Column:
    """Rate zone = clamp(distance + 1, 1, 9)."""
    return F.least(F.lit(9), F.greatest(F.lit(1), _c(dist) + 1))


# P9 / P13 --------------------------------------------------------- labels
def zone_label_number(label) -> Column:
    """'Zone_7' -> 7."""
    return F.regexp_extract(_c(label), r"_(\d+)$", 1).try_cast("int")


def distance_category(origin, dest) -> Column:
    o = F.split(_c(origin), "_").getItem(0)
    d = F.split(_c(dest), "_").getItem(0)
    regional = F.lit(False)
    for grp in rd.REGIONAL_GROUPS:
        regional = regional | (o.isin(list(grp)) & d.isin(list(grp)))
    return F.when(o == d, "domestic").when(regional, "regional").otherwise("international")


# P10-P12 ---------------------------------------------------- rate cards
def rate_card_table(spark: SparkSession) -> DataFrame:
    """36-row dimension (service_level, rate_zone, base_days, base_cost)."""
    rows = [(s, z + 1, rd.BASE_TRANSIT_DAYS[s][z], rd.BASE_COST_USD[s][z])
            for s in rd.RATE_SERVICES for z in range(9)]
    return spark.createDataFrame(rows, "service_level string, rate_zone int, base_days double, base_cost double")


def carrier_effect_table(spark: SparkSession) -> DataFrame:
    rows = [(c, rd.CARRIER_DAYS_OFFSET[c], rd.CARRIER_COST_MULT[c]) for c in rd.CARRIER_DAYS_OFFSET]
    return spark.createDataFrame(rows, "carrier string, days_offset double, cost_mult double")


def with_rate_card(df: DataFrame, service="service_level", zone="rate_zone") -> DataFrame:
    """Left broadcast join of the rate card and the carrier effects (defaults 0 / 1)."""
    spark = df.sparkSession
    rc = F.broadcast(rate_card_table(spark).select(F.col("service_level").alias("_rc_s"),
                                                  F.col("rate_zone").alias("_rc_z"), "base_days", "base_cost"))
    ce = F.broadcast(carrier_effect_table(spark).select(F.col("carrier").alias("_ce_c"), "days_offset",
                                                       "cost_mult"))
    x = df.join(rc, (df[service] == rc["_rc_s"]) & (df[zone] == rc["_rc_z"]), "left")
    x = x.join(ce, x["carrier"] == ce["_ce_c"], "left")
    return x.drop("_rc_s", "_rc_z", "_ce_c").fillna({"days_offset": 0.0, "cost_mult": 1.0})


def round_half_up(x, digits: int) -> Column:
    p = float(10 ** digits)
    return F.round(_c(x) * F.lit(p)) / F.lit(p)


def expected_transit(base="base_days", offset="days_offset") -> Column:
    """Base + carrier offset, clamped to 1..30, 1 decimal."""
    t = _c(base) + _c(offset)
    c = F.greatest(F.lit(rd.MIN_TRANSIT_DAYS), F.least(t, F.lit(rd.MAX_TRANSIT_DAYS)))
    return F.when(t.isNull(), F.lit(None).cast("double")).otherwise(round_half_up(c, 1))


def expected_cost(base="base_cost", mult="cost_mult", billable="billable_weight", month="month") -> Column:
    """Base x carrier multiplier x weight factor x fuel surcharge; floor 3.00; 2 decimals."""
    wf = F.lit(1e0) + (_c(billable) - F.lit(1e0)) * F.lit(rd.BILLABLE_COST_STEP)
    fuel = F.lit(1e0) + (_c(month) % 12) * F.lit(rd.FUEL_STEP)
    c = _c(base) * _c(mult) * wf * fuel
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(rd.MIN_COST_USD), round_half_up(c, 2)))


# P14 ---------------------------------------------------- linear rate model
def service_spec_table(spark: SparkSession) -> DataFrame:
    rows = [(s, *v) for s, v in rd.SERVICE_SPECS.items()]
    return spark.createDataFrame(rows, "service_level string, base_time double, zone_factor double, base_cost double")


def carrier_adjustment_table(spark: SparkSession) -> DataFrame:
    rows = [(c, *v) for c, v in rd.CARRIER_ADJUSTMENTS.items()]
    return spark.createDataFrame(rows, "carrier string, time_mult double, cost_mult double")


def clamp(x, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


def linear_days(base_time, zone_factor, zone, time_mult) -> Column:
    t = (_c(base_time) + (_c(zone) - 1) * _c(zone_factor)) * clamp(time_mult, *rd.TIME_MULT_CLAMP)
    return F.greatest(F.lit(rd.MIN_MODEL_DAYS), t)


def linear_cost(base_cost, zone_factor, zone, weight, volume, cost_mult) -> Column:
    c = (_c(base_cost) + (_c(zone) - 1) * _c(zone_factor) * F.lit(5e-1)
         + _c(weight) * F.lit(rd.WEIGHT_COST) + _c(volume) * F.lit(rd.VOLUME_COST))
    c = c * F.when(_c(weight) > rd.HEAVY_LBS, F.lit(rd.HEAVY_MULT)).when(
        _c(weight) < rd.LIGHT_LBS, F.lit(rd.LIGHT_MULT)).otherwise(F.lit(1e0))
    c = c * clamp(cost_mult, *rd.COST_MULT_CLAMP)
    return F.greatest(F.lit(rd.MIN_MODEL_COST), c)


# P16-P19 ----------------------------------------------------------- bins
def package_category(vol) -> Column:
    """(0,100] Small, (100,500] Medium, (500,1000] Large, (1000,inf) XLarge; <= 0 -> NULL."""
    v = _c(vol)
    return (F.when(v <= 0, F.lit(None).cast("string")).when(v <= 100, "Small").when(v <= 500, "Medium")
            .when(v <= 1000, "Large").when(v.isNotNull(), "XLarge"))


def weight_bins(x, mn, mx, bins: int = 10) -> Column:
    """Right-closed equal-width bin 1..bins over [min, max] (min falls in bin 1)."""
    w = (_c(mx) - _c(mn)) / F.lit(float(bins))
    k = F.ceil((_c(x) - _c(mn)) / w).cast("int")
    return F.when(w == 0, F.lit(1)).otherwise(F.least(F.lit(bins), F.greatest(F.lit(1), k)))


def default_ship_date(d, as_of: str) -> Column:
    """A missing request date becomes the explicit ``as_of`` date."""
    return F.coalesce(_c(d), F.lit(as_of).cast("date"))
