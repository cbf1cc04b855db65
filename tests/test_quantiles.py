"""Exact distributed percentiles against numpy (linear interpolation)."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiplens.functions.quantiles import percentiles


def _np(vals, p):
    return float(np.quantile(np.array(vals, dtype=float), p))


def test_groups_nulls_single_rows_ties(spark):
    rows = [("a", float(v)) for v in [5, 1, 3, 3, 3, 9, 2]] + [("b", 7.0)] + [("c", None), ("c", 4.0), ("c", 4.0)]
    rows += [("d", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.95, 0.99]
    got = {r["k"]: r for r in percentiles(df, ["k"], "v", probs).collect()}
    assert set(got) == {"a", "b", "c"}  # an all-NULL group has no row
    for k, vals in {"a": [5, 1, 3, 3, 3, 9, 2], "b": [7], "c": [4, 4]}.items():
        for p in probs:
            assert got[k][f"p{int(round(p * 100))}"] == pytest.approx(_np(vals, p), abs=1e-12)


def test_global_group_over_many_slices(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.normal(10, 3, 30000), 3)  # many ties, n > accuracy
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = percentiles(df, [], "v", [0.01, 0.5, 0.9], ["a", "b", "c"]).first()
    for name, p in zip("abc", [0.01, 0.5, 0.9]):
        assert got[name] == pytest.approx(_np(vals, p), abs=1e-9)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(min_value=-1e3, max_value=1e3, allow_nan=False), min_size=1, max_size=40),
       st.sampled_from([0.0, 0.3, 0.5, 0.8, 1.0]))
def test_property_matches_numpy(spark, vals, p):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = percentiles(df, [], "v", [p], ["q"]).first()["q"]
    assert got == pytest.approx(_np(vals, p), rel=1e-9, abs=1e-9)


def test_monotone_in_p(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(i % 3), float(x)) for i, x in enumerate(rng.exponential(2, 3000))],
                               "g int, v double")
    ps = [0.1, 0.2, 0.5, 0.8, 0.9]
    for r in percentiles(df, ["g"], "v", ps, [f"q{i}" for i in range(5)]).collect():
        qs = [r[f"q{i}"] for i in range(5)]
        assert qs == sorted(qs)


def test_multi_columns(spark):
    from shiplens.functions.quantiles import percentiles_multi
    rows = [(i % 2, float(i), float(i * i)) for i in range(50)] + [(2, None, 4.0), (3, None, None), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    specs = [("a", [0.5], ["ma"]), ("b", [0.25, 0.75], ["qb1", "qb3"])]
    got = {r[0]: tuple(r[1:]) for r in percentiles_multi(df, ["g"], specs).collect()}
    assert set(got) == {0, 1, 2, None}
    for g in (0, 1):
        a = [float(i) for i in range(50) if i % 2 == g]
        b = [float(i * i) for i in range(50) if i % 2 == g]
        assert got[g] == pytest.approx((_np(a, 0.5), _np(b, 0.25), _np(b, 0.75)))
    assert got[2] == (None, 4.0, 4.0) and got[None] == (1.0, None, None)


def test_a_hot_group_is_split(spark):
    """A group of nearly all rows is ranked in several slices."""
    df = spark.range(0, 40000, numPartitions=4).selectExpr("if(id % 10 = 0, 'b', 'a') AS k", "cast(id * 7919 % 40009 AS double) AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["k"]: r["m"] for r in percentiles(df, ["k"], "v", [0.5], ["m"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for k in "ab":
        assert got[k] == _np([i * 7919 % 40009 for i in range(40000) if (i % 10 == 0) == (k == "b")], 0.5)
