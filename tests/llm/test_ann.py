import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplens.llm.ann import nearest
from tests.llm.conftest import table

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def brute(rows, k, every):
    ok = {(i, tuple(v)) for i, v in ((r[0], r[1]) for r in rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in ok:
        if q % every:
            continue
        near = sorted({(math.sqrt(sum((float(a) - float(b)) ** 2 for a, b in zip(v, w))), c) for c, w in ok if c != q and len(w) == len(v)})
        out += [(q, i + 1, c, d) for i, (d, c) in enumerate(near[:k])]
    return sorted(out)


def vectors(n=300, d=24, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d)).astype(np.float32)
    v[50:90] = v[10] + rng.normal(size=(40, d)).astype(np.float32) * 1e-4   # far closer than int8 can tell
    v[100:110] = v[20]                                                       # ties
    rows = [(i, v[i].tolist(), 0, 1.0, 1) for i in range(n)]
    rows += [(1000, None, 0, 0.0, 0), (1010, [0.0] * d, 0, 0.0, 0), (1020, [float("nan")] * d, 0, 0.0, 0), (1030, [None] + [1.0] * (d - 1), 0, 0.0, 0),
             (1040, [float("inf")] * d, 0, 0.0, 0), (None, [1.0] * d, 0, 0.0, 0), (1050, [], 0, 0.0, 0), (1060, [1.0, 2.0], 0, 0.0, 0),
             (1070, [1.0, 2.5], 0, 0.0, 0), (1080, (v[3] * 1e4).tolist(), 0, 0.0, 0)]
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 20, 1500])
def test_equals_brute_force(spark, block_bytes):
    rows = vectors()
    df = spark.createDataFrame([*rows, rows[20]], SCHEMA).repartition(4)  # a repeated row
    got = table(nearest(df, F.col("vec_id") % 10 == 0, 10, block_bytes))
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, *_ in rows], 10, 10)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(a[3] == pytest.approx(b[3], rel=1e-12, abs=1e-12) for a, b in zip(got, want))


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0, 0.0, 0), (1, [0.0, 1.0], 0, 0.0, 0), (2, [1.0, 0.5], 0, 0.0, 0)], SCHEMA)
    assert [r[:3] for r in table(nearest(df, F.col("vec_id") == 0, 10))] == [(0, 1, 2), (0, 2, 1)]
    assert table(nearest(df.limit(0), F.col("vec_id") == 0, 10)) == []
    assert table(nearest(df, F.col("vec_id") == 99, 10)) == []
