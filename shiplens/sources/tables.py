"""Driver tables and the shipment-shaped fixture views derived from them.

The driver tables are TPC-H-like; the shipment views map them onto the
parcel data model (one fact row per lineitem).  The same mapping exists as SQL
text in :mod:`shiplens.plans.views` for the DuckDB oracle; the expressions
here keep the same operand order so that floating results agree bit for bit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.session import small_join_tasks

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed carrier / service vocabularies of the fixture views (must equal the
# oracle SQL text).
VIEW_CARRIERS = ["USPS", "FedEx", "UPS", "DHL", "Amazon_Logistics", "OnTrac", "LaserShip"]
VIEW_SERVICES = {"1": "OVERNIGHT", "2": "EXPRESS", "3": "PRIORITY", "4": "STANDARD"}
VIEW_SERVICE_DEFAULT = "ECONOMY"
VIEW_BASE_DAYS = {"1": 1.3, "2": 2.2, "3": 3.4, "4": 5.7}
VIEW_BASE_DAYS_DEFAULT = 8.6
REQUEST_CARRIERS = ["USPS", "FedEx", "UPS", "DHL", "Amazon_Logistics", "OnTrac", "LaserShip",
                    "Regional_Express", "TNT"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a lazily scanned Parquet DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key, mapping: dict, default):
    """CASE key WHEN k THEN v ... ELSE default END, in mapping order."""
    items = list(mapping.items())
    expr = F.when(key == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(key == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def _by_mod(key, names: list[str]):
    return _case(key, {i: n for i, n in enumerate(names[:-1])}, names[-1])


def shipments(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Fact view ``shipments``: lineitem x orders x customer x supplier x part.

    Customer is joined to orders first (the smaller side); lineitem meets the
    supplier / part dimensions (broadcast when small) and then orders x
    customer in one shuffle join on the order key.
    """
    small_join_tasks(spark)
    l = (lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_tax", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                              "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    oc = o.join(c, o.o_custkey == c.c_custkey).drop("o_custkey", "c_custkey")
    # dimensions first, the order join last: the fact never looks like the small
    # side to the static planner, so lineitem x orders is a shuffle join that
    # adaptive execution turns into a broadcast only when the orders side is small
    j = (l.join(s, l.l_suppkey == s.s_suppkey)
         .join(p, l.l_partkey == p.p_partkey)
         .join(oc, l.l_orderkey == oc.o_orderkey))
    prio = F.substring(F.col("o_orderpriority"), 1, 1)
    size = F.col("p_size")
    length = F.lit(4e0) + size * F.lit(3e-1)
    width = F.lit(3e0) + size * F.lit(2e-1)
    height = F.lit(2e0) + size * F.lit(1e-1)
    ep = F.col("l_extendedprice") / F.lit(1e5)
    transit = F.greatest(
        F.lit(8e-1),
        _case(prio, VIEW_BASE_DAYS, VIEW_BASE_DAYS_DEFAULT)
        + (F.col("c_nationkey") % 9) * F.lit(1e-1)
        + (F.col("l_suppkey") % 7) * F.lit(5e-2)
        + ep * ep * F.lit(1e1)
        - F.lit(1e0)
        + F.when(F.col("l_orderkey") % 97 == 0, F.lit(2e1)).otherwise(F.lit(0e0)))
    cost = F.greatest(
        F.lit(2.5e0),
        F.col("l_quantity") * F.lit(3e-1)
        + F.col("o_totalprice") / F.lit(2e4)
        + F.col("l_tax") * F.lit(5e1)
        + F.when(F.col("l_orderkey") % 89 == 0, F.lit(6e1)).otherwise(F.lit(0e0)))
    return j.select(
        "l_orderkey", "l_linenumber",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        (F.col("s_nationkey") % 9 + 1).cast("int").alias("origin_zone"),
        (F.col("c_nationkey") % 9 + 1).cast("int").alias("dest_zone"),
        _by_mod((F.col("l_suppkey") % 7).cast("int"), VIEW_CARRIERS).alias("carrier"),
        _case(prio, VIEW_SERVICES, VIEW_SERVICE_DEFAULT).alias("service_level"),
        (F.col("l_quantity") * F.lit(5e-1)).alias("package_weight_lbs"),
        length.alias("package_length_in"),
        width.alias("package_width_in"),
        height.alias("package_height_in"),
        (length * width * height).alias("package_volume_cubic_in"),
        (F.col("l_extendedprice") / F.lit(5e1)).alias("insurance_value"),
        transit.alias("transit_time_days"),
        cost.alias("shipping_cost_usd"),
    )


def shipments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shipments`` plus targets with missing values (NULL, never NaN)."""
    s = shipments(spark, sf_dir)
    return s.select(
        "*",
        F.when(F.col("l_orderkey") % 53 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("transit_time_days")).alias("transit_time_raw"),
        F.when(F.col("l_orderkey") % 101 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("shipping_cost_usd")).alias("shipping_cost_raw"))


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One origin / destination ZIP pair per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        "o_orderkey",
        F.lpad((F.col("c_custkey") * 7919 % 100000).cast("string"), 5, "0").alias("origin_zip"),
        F.lpad(((F.col("o_orderkey") * 104729 + 31) % 100000).cast("string"), 5, "0")
         .alias("dest_zip"))


def requests(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Prediction requests (one per lineitem) including invalid ones."""
    l = (lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    j = l.join(p, l.l_partkey == p.p_partkey)
    size = F.col("p_size")
    service = (F.when(F.col("l_returnflag") == "A", F.lit("Ground"))
               .when(F.col("l_returnflag") == "N", F.lit("Express"))
               .otherwise(F.when(F.col("l_linestatus") == "O", F.lit("Priority"))
                          .otherwise(F.lit("Overnight"))))
    return j.select(
        F.col("l_orderkey").alias("request_id"), "l_linenumber",
        F.when(F.col("l_orderkey") % 101 == 0, F.lit(None).cast("date"))
         .otherwise(F.col("l_shipdate").cast("date")).alias("ship_date"),
        (F.col("l_suppkey") % 11).cast("int").alias("zone"),
        _by_mod((F.col("l_partkey") % 9).cast("int"), REQUEST_CARRIERS).alias("carrier"),
        service.alias("service_level"),
        (F.col("l_quantity") * F.lit(1.5e0)).alias("package_weight_lbs"),
        (F.lit(4e0) + size * F.lit(3e-1)).alias("package_length_in"),
        (F.lit(3e0) + size * F.lit(2e-1)).alias("package_width_in"),
        (F.lit(2e0) + size * F.lit(1e-1)).alias("package_height_in"),
        (F.col("l_extendedprice") / F.lit(1e1)).alias("insurance_value"))


def prediction_events(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Request log: one event per prediction call."""
    e = events if events is not None else table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("request_id"), "ts",
                    (F.col("event_type") != "error").alias("success"),
                    F.col("value").alias("response_ms"))


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A driver table as a Structured Streaming file source (schema from the static table).

    The glob keeps the source on one table's files inside the shared folder.
    """
    schema = table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]"))
