"""Hand-made mini frames for the rules, bins, encodings, split and rolling medians."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shiplens.functions import scalars as sc
from shiplens.operators import distributions as di
from shiplens.operators import features as fe

# the ten lookup cases with the zone the interval chart really yields
ZIP_CASES = [("10001", 8), ("90210", 4), ("60601", 6), ("30301", 7), ("75201", 5), ("80202", 4),
             ("98101", 6), ("33101", 8), ("85001", 4), ("50301", 5)]


def _zones(spark, zips, chart="utils"):
    df = spark.createDataFrame([(z,) for z in zips], "zip string")
    out = sc.with_zip_zone(df, "zip", "zone", chart)
    return {r["zip"]: r["zone"] for r in out.collect()}


def test_zip_cases(spark):
    got = _zones(spark, [z for z, _ in ZIP_CASES])
    assert got == dict(ZIP_CASES)


def test_zip_edge_cases_and_charts(spark):
    utils = _zones(spark, ["05010", "42712", "98512", "30312", "1a001"])
    cost = _zones(spark, ["05010", "42712", "98512", "98712"], chart="cost")
    assert utils == {"05010": 8, "42712": 5, "98512": 6, "30312": 7, "1a001": None}
    assert cost == {"05010": 8, "42712": 6, "98512": 5, "98712": 5}


def test_package_category_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 100.0, 100.0001, 500.0, 1000.0, 1000.1]], "v double")
    got = [r[0] for r in df.select(sc.package_category(F.col("v"))).collect()]
    assert got == [None, "Small", "Medium", "Medium", "Large", "XLarge"]


def test_weight_bins_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 1.5, 10.0]], "v double")
    got = [r[0] for r in df.select(sc.weight_bins(F.col("v"), F.lit(0.0), F.lit(10.0), 10)).collect()]
    assert got == [1, 1, 2, 10]


def test_histogram_constant_column_and_totals(spark):
    s = spark.createDataFrame([("STANDARD", 5, 3.0)] * 4, "service_level string, dest_zone int, transit_time_days double")
    h = di.histogram(s, "STANDARD", 5, "transit_time", 30).collect()
    assert len(h) == 30 and sum(r["count"] for r in h) == 4
    assert [r["bin"] for r in h if r["count"]] == [16]
    assert h[0]["bin_width"] == pytest.approx(1 / 30, abs=1e-6)


def _ship(spark, rows):
    return spark.createDataFrame(rows, "ship_date date, origin_zone int, dest_zone int, carrier string, "
                                       "service_level string, transit_time_days double, shipping_cost_usd double")


def test_rolling_median_excludes_same_day_and_old_history(spark):
    d = dt.date(2024, 3, 1)
    rows = [(d - dt.timedelta(days=40), 1, 2, "UPS", "X", 100.0, 1.0),   # older than 30 days
            (d - dt.timedelta(days=30), 1, 2, "UPS", "X", 2.0, 1.0),     # exactly on the cutoff: kept
            (d - dt.timedelta(days=1), 1, 2, "UPS", "X", 4.0, 1.0),
            (d, 1, 2, "UPS", "X", 50.0, 1.0), (d, 1, 2, "UPS", "X", 60.0, 1.0)]   # same day: excluded
    s = _ship(spark, rows)
    ks = fe.with_keys(s).select("route", "ship_date", "transit_time_days", "shipping_cost_usd")
    out = fe.rolling_route_medians(ks).where(F.col("ship_date") == d).collect()
    assert [r["route_30d_median_time"] for r in out] == [3.0, 3.0]
    first = fe.rolling_route_medians(ks).where(F.col("ship_date") == d - dt.timedelta(days=40)).first()
    assert first["route_30d_median_time"] is None


def test_encoding_unseen_category_gets_prior(spark):
    rows = [(dt.date(2024, 1, 1), 1, 2, "UPS", "X", 2.0, 10.0)] * 3 + [(dt.date(2024, 1, 2), 1, 3, "DHL", "X", 4.0, 20.0)]
    enc = fe.encodings(fe.with_keys(_ship(spark, rows)), 1, 1)
    q = fe.with_keys(_ship(spark, [(dt.date(2024, 1, 3), 9, 9, "Nobody", "Y", 0.0, 0.0)]))
    r = fe.apply_encodings(q, enc).first()
    prior = (2.0 * 3 + 4.0) / 4
    assert r["carrier_te_time"] == pytest.approx(prior)
    lam = 1 / (1 + pytest.importorskip("math").exp(-(3 - 1) / 1))
    e = enc.where("enc_col = 'carrier' AND category = 'UPS' AND target = 'time'").first()
    assert e["enc"] == pytest.approx(prior * (1 - lam) + 2.0 * lam)
    assert min(prior, 2.0) <= e["enc"] <= max(prior, 2.0)


def test_time_split_boundary_day(spark):
    d0 = dt.date(2024, 1, 1)
    rows = []
    for i in range(10):
        day = d0 if i < 3 else d0 + dt.timedelta(days=1)   # cut (8) falls inside day 2
        rows.append((day, i, 1, 1, 1, "UPS", "X", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, float(i), 1.0))
    df = spark.createDataFrame(rows, "ship_date date, l_orderkey long, l_linenumber int, origin_zone int, "
                                     "dest_zone int, carrier string, service_level string, package_weight_lbs double, "
                                     "package_length_in double, package_width_in double, package_height_in double, "
                                     "package_volume_cubic_in double, insurance_value double, "
                                     "transit_time_days double, shipping_cost_usd double")
    out = {r["l_orderkey"]: r["split"] for r in fe.time_split(df).collect()}
    assert len(out) == 10
    assert [k for k, v in sorted(out.items()) if v == "train"] == list(range(8))


def test_rolling_median_equals_brute_force(spark):
    """Ties, sparse days, a hot day, a missing value, different cuts and depths of the count tree."""
    import random
    import statistics
    random.seed(3)
    d0 = dt.date(2024, 1, 1)
    rows = [(d0 + dt.timedelta(days=random.choice([5, random.randint(0, 120)])), random.randint(1, 2), 2, "UPS", "X",
             round(random.uniform(1, 9), 1), None if i % 50 == 0 else round(random.uniform(3, 30), 2)) for i in range(500)]
    ks = fe.with_keys(_ship(spark, rows)).select("route", "ship_date", "transit_time_days", "shipping_cost_usd")
    flat = [tuple(r) for r in ks.collect()]
    want = []
    for route, day, t, c in flat:
        near = [r for r in flat if r[0] == route and 1 <= (day - r[1]).days <= 30]
        mid = [statistics.median(v) if v else None for v in ([r[k] for r in near if r[k] is not None] for k in (2, 3))]
        want.append((route, day, t, c, *mid))
    key = lambda r: tuple((x is not None, x) for x in r)
    for cuts, leaf in ((fe.ROOT_CUTS, 8192), ((.3, .6), 8192), ((.5,), 9), (fe.ROOT_CUTS, 0)):   # the last two go several levels down
        got = fe.rolling_route_medians(ks, cuts=cuts, leaf=leaf).select(
            "route", "ship_date", "transit_time_days", "shipping_cost_usd", "route_30d_median_time", "route_30d_median_cost").collect()
        assert [tuple(r) for r in sorted(got, key=key)] == sorted(want, key=key)


def test_hot_route_is_bounded(spark):
    """Half of all values of a route are one and the same: buckets shrink level by level, whatever repeats."""
    from pyspark.sql import functions as F
    x = spark.range(20_000).select(
        F.lit("1->2").alias("route"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("ship_date"),
        F.when(F.col("id") % 2 == 0, 3.0).otherwise(F.pmod(F.hash("id"), F.lit(9)).cast("double")).alias("transit_time_days"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).alias("shipping_cost_usd"))
    days = x.select("route", "ship_date").distinct()
    got = {r["ship_date"]: (r[2], r[3]) for r in fe.rolling_route_medians(days, x, leaf=200).collect()}
    rows = [tuple(r)[1:] for r in x.collect()]
    import statistics
    for d in sorted(got)[::7]:
        near = [r for r in rows if 1 <= (d - r[0]).days <= 30]
        assert got[d] == ((statistics.median(r[1] for r in near), statistics.median(r[2] for r in near)) if near else (None, None))
