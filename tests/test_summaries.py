"""The percentile cube's store of counts: loads, reloads, pruned reads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shiplens.operators import summaries as su
from shiplens.functions.stats import COST, TIME


@pytest.fixture(scope="module")
def ships(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["UPS", "DHL"]), rng.choice(["Ground", None]), rng.randint(1, 2),
             None if i % 97 == 0 else dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 80)),
             None if i % 50 == 0 else float(rng.randint(1, 6)), round(rng.uniform(3, 9), 1)) for i in range(900)]
    return spark.createDataFrame(rows, f"carrier string, service_level string, dest_zone int, ship_date date, {TIME} double, {COST} double")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_second_load_equals_a_rebuild(spark, ships, tmp_dir):
    path = tmp_dir + "/store"
    cut = dt.date(2024, 2, 20)
    su.load_cube_days(ships.where((F.col("ship_date") <= F.lit(cut)) | F.col("ship_date").isNull()), path)
    su.load_cube_days(ships.where(F.col("ship_date") >= F.lit(cut)), path)      # one day again, and new ones of its month
    want = rows(su.percentile_cube(ships))
    assert len(want) > 20 and rows(su.cube_from_store(spark, path)) == want
    su.load_cube_days(ships.where(F.col("ship_date") >= F.lit(cut)), path)      # twice changes nothing
    assert rows(su.cube_from_store(spark, path)) == want


def test_reload_replaces_a_day_only(spark, ships, tmp_dir):
    path = tmp_dir + "/replace"
    su.load_cube_days(ships, path)
    day = dt.date(2024, 1, 15)
    changed = ships.where(F.col("ship_date") == F.lit(day)).withColumn(COST, F.col(COST) + 100)
    su.load_cube_days(changed, path)
    whole = ships.where((F.col("ship_date") != F.lit(day)) | F.col("ship_date").isNull()).unionByName(changed)
    assert rows(su.cube_from_store(spark, path)) == rows(su.percentile_cube(whole))


def test_range_of_days_reads_its_months(spark, ships, tmp_dir):
    path = tmp_dir + "/range"
    su.load_cube_days(ships, path)
    a, b = dt.date(2024, 2, 3), dt.date(2024, 2, 27)
    got = su.cube_from_store(spark, path, since=a, until=b)
    assert rows(got) == rows(su.percentile_cube(ships.where(F.col("ship_date").between(F.lit(a), F.lit(b)))))
    files = {f.split("month=")[1][:10] for f in spark.read.parquet(path).where("month >= date'2024-02-01' AND month <= date'2024-02-27'").inputFiles()}
    assert "2024-02-01" in files
