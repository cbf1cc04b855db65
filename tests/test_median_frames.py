"""Trailing route medians: frames that only grow, and the bucket of a rank in running sums."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from shiplens.functions.stats import COST, TIME
from shiplens.operators import features as fe


def test_bucket_of_a_rank(spark):
    upto = [0, 2, 2, 5]                    # rows up to each bucket
    want = {0: (1, 0), 1: (1, 0), 2: (3, 2), 4: (3, 2)}
    x = spark.createDataFrame([(p, upto) for p in want], "p long, s array<long>")
    got = {r["p"]: (r["m"]["b"], r["m"]["cum"]) for r in x.select("p", fe._middle(F.col("p"), F.col("s")).alias("m")).collect()}
    assert got == want


def test_frames_of_few_days_by_brute_force(spark, monkeypatch):
    """Days without rows, days that leave the frame and a route that stops; no window goes through its frame again and again."""
    plans = []
    write = fe.materialize
    monkeypatch.setattr(fe, "materialize", lambda df: (plans.append(df._jdf.queryExecution().analyzed().toString()), write(df))[1])
    rng = np.random.default_rng(9)
    start = dt.date(2024, 1, 1)
    rows = [(f"{i % 3}->1", start + dt.timedelta(int(d)), float(rng.integers(0, 6)), float(rng.random()))
            for i, d in enumerate(rng.choice([0, 1, 2, 3, 7, 8, 9, 10, 15], 300)) if i % 3 or d < 8]
    x = spark.createDataFrame(rows, f"route string, ship_date date, {TIME} double, {COST} double")
    got = fe.rolling_route_medians(x, days=3, leaf=4).select(
        "route", "ship_date", "route_30d_median_time", "route_30d_median_cost").distinct().collect()
    assert len(got) == len({r[:2] for r in rows})
    for route, day, *medians in got:
        near = [r for r in rows if r[0] == route and 1 <= (day - r[1]).days <= 3]
        want = [float(np.median([r[k] for r in near])) if near else None for k in (2, 3)]
        assert all((a is None and b is None) or abs(a - b) < 1e-12 for a, b in zip(medians, want))
    frames = [p for p in plans if "windowspecdefinition" in p]
    assert any("RangeFrame, unboundedpreceding" in p for p in frames) and not any("RangeFrame, cast(-3" in p for p in frames)
