"""Percentiles by counted buckets: nested sets, weights, NULL keys, buckets that are cut again."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplens.functions.quantiles import percentiles, percentiles_multi
from shiplens.operators import summaries as su


def test_buckets_are_cut_again(spark):
    """With small leaves the tree goes down several levels; ties, weights and NULL keys keep their ranks."""
    rng = np.random.default_rng(3)
    rows = [(k, float(v), int(w)) for k in ("a", None) for v, w in zip(np.round(rng.exponential(5, 1500), 2), rng.integers(1, 4, 1500))]
    rows += [("t", 7.0, 1)] * 900 + [("t", 8.0, 2)] * 3
    df = spark.createDataFrame(rows, "k string, v double, n long")
    probs = [0.0, 0.1, 0.5, 0.99, 1.0]
    names = [f"q{i}" for i in range(5)]
    got = {r["k"]: r for r in percentiles_multi(df, ["k"], [("v", probs, names)], weight="n", leaf=3).collect()}
    for k in ("a", None, "t"):
        vals = np.repeat([v for a, v, _ in rows if a == k], [w for a, _, w in rows if a == k])
        assert [got[k][n] for n in names] == pytest.approx(np.quantile(vals, probs), abs=1e-9)


def test_no_row_is_grouped_by_value(spark):
    """The written tables of a call hold the input once and then only a few rows a bucket, not a row a value."""
    import shiplens.functions.quantiles as qu
    df = spark.range(40000).select((F.col("id") * 7919 % 40009).cast("double").alias("v"))
    written, plain = [], qu.materialize

    def spy(x):
        out = plain(x)
        written.append(out.count())
        return out
    qu.materialize = spy
    try:
        got = percentiles(df, [], "v", [0.5], ["m"]).first()["m"]
    finally:
        qu.materialize = plain
    assert got == np.quantile([i * 7919 % 40009 for i in range(40000)], 0.5)
    assert max(written[1:]) < 4000


def test_nested_sets_by_brute_force(spark):
    """percentile_filtered against numpy, set by set: NULL cost, a NULL key, equal values, cells of one row."""
    rng = np.random.default_rng(5)
    rows = [(c, float(np.round(t, 1)), None if i % 17 == 0 else float(np.round(x, 2)))
            for c in ("u", "v", None) for i, (t, x) in enumerate(zip(rng.gamma(2, 2, 400), rng.gamma(3, 9, 400)))]
    rows += [("one", 3.0, 4.0)] + [("same", 2.0, 1000003.7)] * 30
    df = spark.createDataFrame(rows, f"carrier string, {su.TIME} double, {su.COST} double")
    got = {(r["carrier"], r["percentile"], r["method"]): r for r in su.percentile_filtered(df, (50, 80, 95), ("median", "mean"), ["carrier"]).collect()}
    assert len(got) == 5 * 3 * 2
    for (k, p, method), r in got.items():
        own = [(t, x) for c, t, x in rows if c == k]
        top = np.quantile([t for t, _ in own], p / 100)
        kept = [(t, x) for t, x in own if t <= top]
        time, cost = [t for t, _ in kept], [x for _, x in kept if x is not None]
        f = np.median if method == "median" else np.mean
        assert (r["records_in_percentile"], r["total_shipments"]) == (len(kept), len(own))
        assert (r["avg_transit_time"], r["avg_cost"]) == pytest.approx((f(time), f(cost)), abs=2e-6)
        for n, v in (("transit_time_std", time), ("cost_std", cost)):
            assert r[n] == (pytest.approx(np.std(v, ddof=1), abs=2e-6) if len(v) > 1 else None)
