"""Normal scores and Shapiro-Wilk as aggregates, against the published algorithm step by step."""

import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from shiplens.functions.stats import COST, TIME, normal_quantile, normal_upper
from shiplens.operators import distributions as di


def test_normal_functions(spark):
    x = spark.range(1, 4000).select((F.col("id") / 4000).alias("p"), ((F.col("id") - 2000) / 400).alias("z"))
    nd = NormalDist()
    for r in x.select("p", "z", F.expr(normal_quantile("p")).alias("q"), F.expr(normal_upper("z")).alias("u")).collect():
        assert r["q"] == pytest.approx(nd.inv_cdf(r["p"]), abs=1e-12)
        assert r["u"] == pytest.approx(1 - nd.cdf(r["z"]), abs=3e-8)


def royston(x):
    """W and p of AS R94, weight by weight."""
    x, n, nd = sorted(x), len(x), NormalDist()
    if n < 3 or x[-1] == x[0]:
        return None, None
    poly = lambda cs, u: sum(c * u ** k for k, c in enumerate(cs))
    m = [nd.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    mm, u = sum(v * v for v in m), 1 / math.sqrt(n)
    if n == 3:
        a = [-math.sqrt(0.5), 0, math.sqrt(0.5)]
    else:
        an, an1 = m[-1] / math.sqrt(mm) + poly(di.SW_LAST, u), m[-2] / math.sqrt(mm) + poly(di.SW_SECOND, u)
        if n <= 5:
            phi = (mm - 2 * m[-1] ** 2) / (1 - 2 * an ** 2)
            a = [-an, *[v / math.sqrt(phi) for v in m[1:-1]], an]
        else:
            phi = (mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * an ** 2 - 2 * an1 ** 2)
            a = [-an, -an1, *[v / math.sqrt(phi) for v in m[2:-2]], an1, an]
    mean = sum(x) / n
    w = min(1.0, sum(p * q for p, q in zip(a, x)) ** 2 / sum((v - mean) ** 2 for v in x))
    if n == 3:
        return w, max(0.0, min(1.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))))
    if n <= 11:
        y, k, c = -math.log(poly(di.SW_GAMMA, n) - math.log(1 - w)), n, di.SW_SMALL
    else:
        y, k, c = math.log(1 - w), math.log(n), di.SW_LARGE
    return w, 1 - nd.cdf((y - poly(c[0], k)) / math.exp(poly(c[1], k)))


def test_shapiro_wilk_against_the_algorithm(spark):
    rng = random.Random(1)
    sizes = [1, 2, 3, 4, 5, 6, 11, 12, 50, 700]
    data = {z: [rng.gauss(5, 2) if z % 2 else rng.expovariate(1) for _ in range(n)] for z, n in enumerate(sizes, 1)}
    data[20] = [3.0] * 9
    rows = [(z * 10_000 + i, 1, "s", z, v, None if i % 2 else v * 2) for z, vs in data.items() for i, v in enumerate(vs)]
    s = spark.createDataFrame(rows, f"l_orderkey long, l_linenumber int, service_level string, dest_zone int, {TIME} double, {COST} double")
    got = {(r["zone"], r["metric"]): r for r in di.shapiro_wilk(s).collect()}
    for z, vs in data.items():
        for metric, x in (("transit_time", vs), ("shipping_cost", [2 * v for v in vs[::2]])):
            w, p = royston(x)
            r = got[z, metric]
            assert r["n_sample"] == len(x)
            assert r["shapiro_wilk_statistic"] == (None if w is None else pytest.approx(w, abs=2e-6))
            assert r["shapiro_wilk_p_value"] == (None if p is None else pytest.approx(p, abs=2e-6))
            assert r["is_normal_p05"] == (p is not None and p > 0.05)
    small = {(r["zone"], r["metric"]): r["n_sample"] for r in di.shapiro_wilk(s, sample=40).collect()}
    assert small[10, "transit_time"] == 40 and small[8, "transit_time"] == 12
