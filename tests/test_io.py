"""Sources and sinks: suffix dispatch, Parquet/CSV round trip, profile default."""

import pytest

from shiplens.operators.quality import training_profile
from shiplens.sources import io
from shiplens.sources import tables as tb


def test_suffix_dispatch_and_round_trip(spark, sf_dir, tmp_dir):
    s = tb.shipments(spark, sf_dir).select("l_orderkey", "carrier", "service_level", "transit_time_days")
    io.write_table(s, tmp_dir + "/ship", partition_by=["service_level"])
    a = io.read_table(spark, tmp_dir + "/ship.parquet")
    b = io.read_table(spark, tmp_dir + "/ship.csv", schema=a.schema)
    assert a.count() == b.count() == s.count()
    assert sorted(a.columns) == sorted(b.columns)
    with pytest.raises(ValueError):
        io.read_table(spark, tmp_dir + "/ship.json")


def test_profile_default_and_round_trip(spark, sf_dir, tmp_dir):
    d = io.read_profile(spark, tmp_dir + "/missing").first()
    assert d["total_shipments"] == 0 and d["version"] == "unknown"
    io.write_profile(training_profile(tb.shipments(spark, sf_dir)), tmp_dir + "/profile", version="2.0")
    p = io.read_profile(spark, tmp_dir + "/profile").first()
    assert p["total_shipments"] == tb.shipments(spark, sf_dir).count() and p["version"] == "2.0"
