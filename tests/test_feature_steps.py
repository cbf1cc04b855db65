"""Steps of the feature table that must not read the fact rows more often than needed."""

from shiplens.operators import features as fe
from shiplens.sources import tables as tb


def test_split_and_medians_read_the_rows_once_a_part(spark, sf_dir):
    """The split is two scans (rows beside the cut, rows of its order key), and the medians join as a written table."""
    s = tb.shipments(spark, sf_dir)
    split = fe.time_split(s)
    assert split._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    rows = fe.materialize(fe.with_keys(s).select("route", "ship_date", fe.TIME, fe.COST))
    out = fe.rolling_route_medians(rows)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert out.count() == rows.count()
