"""Group summaries by service level, carrier and zone.

All of them are one partial-aggregating shuffle over the fact rows (group
keys have tens to hundreds of values, so the shuffled data is a few rows per
task); medians come from :func:`shiplens.functions.quantiles.percentiles`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.functions.quantiles import null_safe_join, percentiles, percentiles_multi, percentiles_of_metrics
from shiplens.functions.stats import COST, TIME, cnt, counted_avg, counted_squares, exact_avg, r6, sorted_list
from shiplens.session import checkpoint_dir, materialize, materialize_small

CELL = ["carrier", "service_level", "dest_zone"]


def _moments(prefix_time="transit_time", prefix_cost="cost"):
    return [exact_avg(TIME).alias(f"avg_{prefix_time}"), exact_avg(COST).alias(f"avg_{prefix_cost}"),
            F.stddev_samp(TIME).alias(f"{prefix_time}_std"),
            F.stddev_samp(COST).alias(f"{prefix_cost}_std")]


def service_summary(s: DataFrame) -> DataFrame:
    """Per service level: shipments, mean/std of time and cost, zones served."""
    g = s.groupBy("service_level").agg(cnt().alias("total_shipments"), *_moments(),
                                       sorted_list(F.col("dest_zone")).alias("zones_served"))
    return g.select("service_level", "total_shipments",
                    *[r6(c).alias(c) for c in ("avg_transit_time", "avg_cost",
                                                "transit_time_std", "cost_std")],
                    "zones_served")


def _with_medians(s: DataFrame, keys: Sequence[str], extra=()) -> DataFrame:
    keys = list(keys)
    s = materialize(s.select(*dict.fromkeys([*keys, "dest_zone", TIME, COST])))  # two passes, one evaluation
    g = s.groupBy(*keys).agg(cnt().alias("total_shipments"), *_moments(), *extra)
    med = percentiles_multi(s, keys, [(TIME, [0.5], ["median_transit_time"]), (COST, [0.5], ["median_cost"])])
    out = null_safe_join(g, med, keys)
    rest = [c for c in out.columns if c not in keys and c != "total_shipments"]
    return out.select(*keys, "total_shipments",
                      *[r6(c).alias(c) if c != "zones_served" else F.col(c) for c in rest])


def carrier_service_summary(s: DataFrame) -> DataFrame:
    """Per carrier x service: E1 figures plus medians."""
    return _with_medians(s, ["carrier", "service_level"],
                         [sorted_list(F.col("dest_zone")).alias("zones_served")])


def carrier_zone_summary(s: DataFrame) -> DataFrame:
    """Per carrier x service x destination zone."""
    return _with_medians(s, CELL).withColumnRenamed("dest_zone", "zone")


def cell_counts(s: DataFrame, keys: Sequence[str] = CELL, extra: Sequence[str] = ()) -> DataFrame:
    """Rows of ``s`` by cell, transit time and cost: all that the percentile-filtered figures need."""
    return s.groupBy(*keys, *extra, TIME, COST).agg(cnt().alias("n"))


def percentile_filtered(s: DataFrame, percentiles_: Sequence[float] = (50,),
                        methods: Sequence[str] = ("median",), keys: Sequence[str] = CELL) -> DataFrame:
    """E4 / A12 core: keep rows whose transit time is <= the group's p-th percentile."""
    rows = materialize(s.select(*keys, TIME, COST, F.lit(1).cast("long").alias("n")))
    return percentile_figures(rows, percentiles_, methods, keys)


def percentile_figures(c: DataFrame, percentiles_: Sequence[float] = (50,),
                       methods: Sequence[str] = ("median",), keys: Sequence[str] = CELL) -> DataFrame:
    """E4 / A12 from rows (keys, time, cost, n) that stand for ``n`` shipments each.

    The sets that the percentiles keep are nested, so each row gets the number of the first set
    that keeps it and is never repeated: sums are taken per group and first set and added up
    over the sets, medians come from the same nested counts.
    """
    keys = list(keys)
    pcts = sorted(float(p) for p in percentiles_)
    names = [f"_t{i}" for i in range(len(pcts))]
    thr = materialize(percentiles(c, keys, TIME, [p / 100.0 for p in pcts], names, weight="n"))
    tot = c.groupBy(*keys).agg(F.sum("n").alias("total_shipments"))
    # thresholds do not fall from one percentile to the next
    first = sum(((F.col(TIME) > F.col(n)).cast("int") for n in names), F.lit(0)).alias("_l")
    kept = materialize(null_safe_join(c, thr, keys).select(*keys, TIME, COST, "n", first).where(
        F.col(TIME).isNotNull() & (F.col("_l") < len(pcts))))
    exact = lambda x: F.sum(F.col(x).cast("decimal(19,7)") * F.col("n").cast("decimal(18,0)"))
    band = keys + ["_l"]
    sums = materialize(kept.groupBy(*band).agg(F.sum("n").alias("_n"), *[a for m, x in (("t", TIME), ("c", COST)) for a in (
        exact(x).alias(f"_s{m}"), F.sum(F.when(F.col(x).isNotNull(), F.col("n"))).alias(f"_k{m}"))]))
    near = sums.select(*band, *[(F.col(f"_s{m}").cast("double") / F.col(f"_k{m}")).alias(f"_r{m}") for m in "tc"])
    spread = null_safe_join(kept, near, band).groupBy(*band).agg(*[a for m, x in (("t", TIME), ("c", COST)) for a in (
        counted_avg(x, "n", f"_r{m}").alias(f"_m{m}"), counted_squares(x, "n", f"_r{m}").alias(f"_q{m}"))])
    sets = materialize(null_safe_join(sums, spread, band).withColumn(
        "_i", F.explode(F.sequence(F.col("_l"), F.lit(len(pcts) - 1)))))
    pk = keys + ["_i"]
    whole = sets.groupBy(*pk).agg(F.sum("_n").alias("records_in_percentile"), *[F.sum(f"_k{m}").alias(f"_a{m}") for m in "tc"], *[
        (F.sum(f"_s{m}").cast("double") / F.sum(f"_k{m}")).alias(f"_mean_{m}") for m in "tc"], *[
        (F.sum(F.col(f"_k{m}") * F.col(f"_m{m}")) / F.sum(f"_k{m}")).alias(f"_middle_{m}") for m in "tc"])
    # squares around a set's mean: those around the means of its parts, and those of the parts' means
    left = lambda m: F.sum(F.col(f"_q{m}") + F.col(f"_k{m}") * (F.col(f"_m{m}") - F.col(f"_middle_{m}")) ** 2)
    out = null_safe_join(sets, whole, pk).groupBy(*pk).agg(
        F.first("records_in_percentile").alias("records_in_percentile"), *[F.first(f"_mean_{m}").alias(f"_mean_{m}") for m in "tc"],
        *[F.when(F.first(f"_a{m}") > 1, F.sqrt(left(m) / (F.first(f"_a{m}") - 1))).alias(n) for m, n in (("t", "transit_time_std"), ("c", "cost_std"))])
    per = null_safe_join(tot, thr, keys)
    if "median" in methods:
        med = [[[f"_{m}{i}"] for i in range(len(pcts))] for m in ("medt", "medc")]
        per = null_safe_join(per, percentiles_multi(kept, keys, [(TIME, [0.5], med[0]), (COST, [0.5], med[1])], weight="n",
                                                    level="_l", sets=len(pcts)), keys)
    per = per.select(*keys, "total_shipments", F.explode(F.array(*[F.struct(
        F.lit(i).alias("_i"), F.lit(p).alias("percentile"), F.col(names[i]).alias("percentile_threshold"),
        *([F.col(f"_med{m}{i}").alias(f"_med_{m}") for m in "tc"] if "median" in methods else [])) for i, p in enumerate(pcts)])).alias("_p")) \
        .select(*keys, "total_shipments", "_p.*")
    out = null_safe_join(per, out, pk)
    meth = c.sparkSession.createDataFrame([(m,) for m in methods], "method string")
    out = out.crossJoin(F.broadcast(meth))
    mt = F.when(F.col("method") == "median", F.col("_med_t")) if "median" in methods else None
    mc = F.when(F.col("method") == "median", F.col("_med_c")) if "median" in methods else None
    mt = mt.otherwise(F.col("_mean_t")) if mt is not None else F.col("_mean_t")
    mc = mc.otherwise(F.col("_mean_c")) if mc is not None else F.col("_mean_c")
    return out.select(
        *[F.col(k) for k in keys], F.col("percentile").cast("double").alias("percentile"), "method",
        "total_shipments", "records_in_percentile",
        r6(F.col("records_in_percentile") / F.col("total_shipments") * 100).alias("percentile_coverage"),
        r6("percentile_threshold").alias("percentile_threshold"),
        r6(mt).alias("avg_transit_time"), r6(mt).alias("median_transit_time"),
        r6(mc).alias("avg_cost"), r6(mc).alias("median_cost"),
        r6("transit_time_std").alias("transit_time_std"), r6("cost_std").alias("cost_std"))


def carrier_zone_percentile(s: DataFrame, percentile: float = 50, method: str = "median") -> DataFrame:
    """Percentile-filtered carrier x service x zone summary."""
    if not 0 <= percentile <= 100:
        raise ValueError("percentile must be within 0..100")
    if method not in ("median", "mean"):
        raise ValueError("method must be 'median' or 'mean'")
    return (percentile_filtered(s, [percentile], [method])
            .drop("percentile", "method").withColumnRenamed("dest_zone", "zone"))


CUBE_PERCENTILES = (50, 70, 80, 85, 90, 95)
CUBE_SCHEMA = ("carrier string, service_level string, zone int, percentile double, method string, total_shipments long, "
               "records_in_percentile long, percentile_coverage double, percentile_threshold double, "
               "avg_transit_time double, median_transit_time double, avg_cost double, median_cost double, "
               "transit_time_std double, cost_std double")


def percentile_cube(s: DataFrame) -> DataFrame:
    """E4 for every prewarmed percentile x method, in one job."""
    return percentile_filtered(s, CUBE_PERCENTILES, ("median", "mean")).withColumnRenamed(
        "dest_zone", "zone")


def write_percentile_cube(s: DataFrame, path: str) -> str:
    """A12 sink: the cube, one folder per percentile and method, so that a report on one of
    them reads that folder alone."""
    percentile_cube(s).write.mode("overwrite").partitionBy("percentile", "method").parquet(path)
    return path


def read_percentile_cube(spark: SparkSession, path: str, percentile: float | None = None,
                         method: str | None = None) -> DataFrame:
    """A12 source: the stored cube, or the part for a percentile and method (pruned folders)."""
    cube = spark.read.schema(CUBE_SCHEMA).parquet(path)
    if percentile is not None:
        cube = cube.where(F.col("percentile") == float(percentile))
    return cube if method is None else cube.where(F.col("method") == method)


def stored_percentile_cube(s: DataFrame) -> DataFrame:
    """A12 query: the cube written to shared storage and read back."""
    path = f"{checkpoint_dir(s.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    return read_percentile_cube(s.sparkSession, write_percentile_cube(s, path))


# ------------------------------------------------- A12 that follows new data
COUNT_SCHEMA = f"carrier string, service_level string, dest_zone int, ship_date date, {TIME} double, {COST} double, n long, month date"


def load_cube_days(s: DataFrame, path: str) -> str:
    """A12 load: counts of the days in ``s`` into the store at ``path``, one folder a month.

    Of the table only the rows handed in are read, of the store only the months they lie in.  A day
    that is loaded again is replaced (``s`` then holds all its rows), other days stay as they
    are, and a load that is run twice changes nothing.
    """
    spark = s.sparkSession
    month = F.trunc("ship_date", "month").alias("month")
    cols = [c.split()[0] for c in COUNT_SCHEMA.split(", ")]
    s = s.select(*CELL, "ship_date", TIME, COST)
    out = cell_counts(s, extra=["ship_date"]).select("*", month).select(*cols)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        days = materialize_small(s.select("ship_date", month).distinct())      # a row a day
        months = [r["month"] for r in days.select("month").distinct().collect()]
        held = spark.read.schema(COUNT_SCHEMA).parquet(path).where(F.col("month").isin([m for m in months if m]) | (
            F.col("month").isNull() & F.lit(None in months)))
        out = out.unionByName(materialize(null_safe_anti(held, days, "ship_date")))
    out.repartitionByRange("month", *CELL, COST).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return path


def null_safe_anti(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose ``key`` is not in ``b``, NULL being a key like any other."""
    return a.join(b.select(F.col(key).alias("__k")), a[key].eqNullSafe(F.col("__k")), "left_anti")


def cube_from_store(spark: SparkSession, path: str, percentiles_: Sequence[float] = CUBE_PERCENTILES, since=None, until=None) -> DataFrame:
    """A12 from the stored counts, of all days or those of ``since`` .. ``until`` (other months are not read)."""
    days = spark.read.schema(COUNT_SCHEMA).parquet(path)
    if since is not None:
        days = days.where((F.col("ship_date") >= F.lit(since)) & (F.col("month") >= F.trunc(F.lit(since).cast("date"), "month")))
    if until is not None:
        days = days.where((F.col("ship_date") <= F.lit(until)) & (F.col("month") <= F.lit(until).cast("date")))
    merged = materialize(days.groupBy(*CELL, TIME, COST).agg(F.sum("n").alias("n")))
    return percentile_figures(merged, percentiles_, ("median", "mean")).withColumnRenamed("dest_zone", "zone")


def incremental_percentile_cube(s: DataFrame) -> DataFrame:
    """A12 query: a store loaded in two steps (all but the last tenth of the days, then those and, once
    more, the last day before them); equals the cube of the whole table."""
    path = f"{checkpoint_dir(s.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    s = materialize(s.select(*CELL, "ship_date", TIME, COST))
    cut = s.agg(F.date_sub(F.max("ship_date"), F.floor(F.datediff(F.max("ship_date"), F.min("ship_date")) / 10).cast("int")).alias("d")).first()["d"]
    if cut is not None:
        load_cube_days(s.where((F.col("ship_date") <= F.lit(cut)) | F.col("ship_date").isNull()), path)
        load_cube_days(s.where(F.col("ship_date") >= F.lit(cut)), path)
        return cube_from_store(s.sparkSession, path)
    return percentile_cube(s)


def distribution_metadata(s: DataFrame) -> DataFrame:
    """Per service x zone x metric: mean, std, median, min, max, count."""
    s = materialize(s.select("service_level", "dest_zone", TIME, COST))  # two passes, one evaluation
    long = s.select("service_level", F.col("dest_zone").alias("zone"), F.explode(F.array(
        F.struct(F.lit("transit_time").alias("metric"), F.col(TIME).alias("v")),
        F.struct(F.lit("shipping_cost").alias("metric"), F.col(COST).alias("v")))).alias("_m")
    ).select("service_level", "zone", "_m.metric", "_m.v")
    keys = ["service_level", "zone", "metric"]
    g = long.groupBy(*keys).agg(exact_avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                                F.min("v").alias("min"), F.max("v").alias("max"),
                                cnt("v").alias("count"))
    med = percentiles_of_metrics(s, ["service_level", F.col("dest_zone").alias("zone")], "metric", {"transit_time": TIME, "shipping_cost": COST},
                                 [0.5], ["median"])
    out = null_safe_join(g, med, keys)
    return out.select(*keys, *[r6(c).alias(c) for c in ("mean", "std", "median", "min", "max")],
                      "count")


def summary_rollup(s: DataFrame) -> DataFrame:
    """E1/E2/E3 levels in one pass with GROUPING SETS."""
    sets = [["service_level"], ["carrier", "service_level"], ["carrier", "service_level", "dest_zone"]]
    g = s.groupingSets(sets, "carrier", "service_level", "dest_zone").agg(
        cnt().alias("total_shipments"), *_moments(),
        F.grouping("carrier").alias("_gc"), F.grouping("dest_zone").alias("_gz"))
    level = (F.when(F.col("_gc") == 1, F.lit("service"))
             .when(F.col("_gz") == 1, F.lit("carrier_service"))
             .otherwise(F.lit("carrier_service_zone")))
    return g.select(level.alias("level"), "carrier", "service_level", F.col("dest_zone").alias("zone"),
                    "total_shipments", *[r6(c).alias(c) for c in ("avg_transit_time", "avg_cost",
                                                                   "transit_time_std", "cost_std")])
