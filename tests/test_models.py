"""Models: quality against the route-median baseline, determinism, persistence, quantile order."""

import pytest
from pyspark.sql import functions as F

from shiplens.operators import features as fe
from shiplens.operators import models as mo
from shiplens.sources import io
from shiplens.sources import tables as tb


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    s = tb.shipments(spark, sf_dir)
    ft = mo.training_table(s)
    return s, dict(mo.fit_all(s, ft=ft, min_rows=20, patience=15), training_table=ft)


def test_quantiles_monotone_and_cover(spark, sf_dir, fitted):
    _, models = fitted
    pred = mo.batch_predict(tb.requests(spark, sf_dir), models, quantiles=True).where("success")
    bad = pred.where((F.col("time_q10") > F.col("time_q50")) | (F.col("time_q50") > F.col("time_q90"))).count()
    assert bad == 0
    assert pred.count() > 0


def test_boosting_beats_the_route_median(fitted):
    """Many trees, and a validation error below the route-median baseline."""
    s, models = fitted
    ev = {(r["target"], r["model"]): r for r in mo.evaluate(models).collect()}
    base = {r["target"]: r for r in mo.baseline_eval(s).collect()}
    assert set(ev) == {(t, m) for t in ("time", "cost") for m in ("point", "q10", "q50", "q90")}
    for t in ("time", "cost"):
        assert len(models[f"model_{t}"]) > 5 and all(len(m) == len(models[f"model_{t}"]) for m in models[f"qmodel_{t}"])
        assert ev[(t, "point")]["mae"] < 0.9 * base[t]["mae"]
        assert ev[(t, "q10")]["coverage"] < ev[(t, "q90")]["coverage"]


def test_best_prefix_is_kept(fitted):
    """The kept trees are those up to the least validation error, and give that error again."""
    _, models = fitted
    v = models["training_table"].where("is_valid")
    for t in ("time", "cost"):
        m = models[f"model_{t}"]
        assert len(m) == min(range(len(m.errors)), key=m.errors.__getitem__) and len(m.errors) - 1 - len(m) == 15
        got = mo.point_predictions(v, m, t).agg(F.avg(F.abs(F.col(fe.TARGETS[t]) - F.col(f"pred_{t}")))).first()[0]
        assert got == pytest.approx(m.errors[len(m)], rel=1e-6)


def test_pinball_below_the_leaf_table(spark, fitted):
    """Boosted bounds against one tree with exact leaf quantiles: less pinball loss on validation rows."""
    _, models = fitted
    x = models["training_table"].where("is_valid")
    for t in ("time", "cost"):
        tree, table = mo.fit_quantile_tree(models["training_table"], t, min_rows=20)
        plain = tree.transform(x).join(F.broadcast(table), f"leaf_{t}", "left")
        boosted = mo.quantile_predictions(x, models[f"qmodel_{t}"], t)
        loss = []
        for df in (boosted, plain):
            e = lambda q: F.col(fe.TARGETS[t]) - F.col(f"q{int(q * 100)}_{t}")
            loss.append(df.agg(sum(F.avg(F.greatest(q * e(q), (q - 1) * e(q))) for q in mo.QUANTILES)).first()[0])
        assert loss[0] < loss[1]


def test_save_load_same_predictions(spark, sf_dir, fitted, tmp_dir):
    _, models = fitted
    io.save_models(models, tmp_dir + "/m")
    loaded = io.load_models(spark, tmp_dir + "/m")
    req = tb.requests(spark, sf_dir)
    a = sorted(tuple(r) for r in mo.batch_predict(req, models).collect())
    b = sorted(tuple(r) for r in mo.batch_predict(req, loaded).collect())
    assert a == b


def test_scoring_uses_history(spark, sf_dir, fitted):
    """With a history the route medians feed the scorer: other predictions, same outcomes."""
    s, models = fitted
    req = tb.requests(spark, sf_dir)
    cols = ["request_id", "l_linenumber", "success", "reasons"]
    a, b = mo.batch_predict(req, models), mo.batch_predict(req, models, history=s)
    assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))
    assert b.where("success AND (predicted_cost_usd IS NULL OR predicted_transit_days IS NULL)").count() == 0
    cost = [sorted(r[0] for r in x.where("success").select("predicted_cost_usd").collect()) for x in (a, b)]
    assert len(cost[0]) == len(cost[1]) and cost[0] != cost[1]


def test_stream_scores_with_the_pipeline(spark, sf_dir, fitted, tmp_dir):
    from shiplens.streaming import jobs as sj
    _, models = fitted
    q = sj.start_model_score(spark, sf_dir, tmp_dir + "/scored", models, base=tmp_dir)
    q.awaitTermination(300)
    got = spark.read.parquet(tmp_dir + "/scored")
    want = mo.batch_predict(tb.requests(spark, sf_dir), models)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_stream_scores_on_history(spark, sf_dir, fitted, tmp_dir):
    """The stream with stored route medians equals the batch scorer with the history; a refreshed table
    counts from the next batch on."""
    from shiplens.streaming import jobs as sj
    s, models = fitted
    some = s.where("ship_date < DATE'1995-01-01'")
    for epoch, hist in enumerate((some, s)):
        sj.store_route_medians(hist, tmp_dir + "/medians", epoch)
        q = sj.start_history_score(spark, sf_dir, tmp_dir + f"/on_history{epoch}", models, tmp_dir + "/medians", base=tmp_dir + f"/h{epoch}")
        q.awaitTermination(300)
        got = spark.read.parquet(tmp_dir + f"/on_history{epoch}/epoch=*")
        want = mo.batch_predict(tb.requests(spark, sf_dir), models, history=hist)
        assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_lane_segments(spark, sf_dir):
    seg = mo.lane_segments(tb.shipments(spark, sf_dir))
    rows = seg.collect()
    lanes = tb.shipments(spark, sf_dir).select("origin_zone", "dest_zone").distinct().count()
    assert len(rows) == lanes
    assert sorted({r["segment"] for r in rows}) == [0, 1, 2, 3]
    means = {r["segment"]: r["shipping_cost_usd"] for r in mo.segment_summary(tb.shipments(spark, sf_dir)).collect()}
    assert [means[k] for k in sorted(means)] == sorted(means.values())


def steep(spark, n=400):
    x = spark.range(n).select(F.col("id"), (F.col("id") % 4 == 0).alias("is_valid"), (F.col("id") / n).alias("x"))
    return x.select("is_valid", (60 * F.col("x")).alias(fe.TARGETS["time"]), *[F.col("x").alias(c) for c in fe.TIME_FEATURES])


def test_boosting_goes_on_while_the_error_falls(spark):
    """Stumps on a steep line, a small step: hundreds of rounds, then the early stop."""
    m = mo.fit_regressors(steep(spark), ["time"], patience=10, depth=1, min_rows=1, step=0.05, max_rounds=120)["time"]
    assert len(m) > 60 and m.errors[len(m)] < 0.8 * m.errors[40]
    assert mo.BOOST_PARAMS["max_rounds"] == 5000 and mo.BOOST_PARAMS["patience"] == 150


def test_default_path_ends(spark, sf_dir):
    """The registered query with its own parameters: early stop after 150 rounds without a better one."""
    from shiplens.plans.registry import QUERIES
    assert QUERIES["train_time_model"](spark, sf_dir).where("pred_time IS NULL").count() == 0
    f = mo.fitted_for(spark, sf_dir)
    for t in ("time", "cost"):
        assert len(f[f"model_{t}"].errors) == len(f[f"model_{t}"]) + 1 + 150


def test_partitions_do_not_matter(spark):
    """Rows are drawn by their content: another partitioning gives the same trees."""
    x = steep(spark)
    a, b = (mo.fit_regressors(x.repartition(n), ["time"], patience=5, depth=3, min_rows=5, max_rounds=12)["time"] for n in (1, 5))
    assert a.errors == pytest.approx(b.errors)


def test_degenerate_tables(spark):
    x = steep(spark)
    empty = mo.fit_regressors(x.where("false"), ["time"])["time"]
    assert len(empty) == 0
    only = mo.fit_regressors(x.withColumn("is_valid", F.lit(False)), ["time"], patience=4, depth=2, min_rows=5)["time"]
    assert len(only) == 4                                   # nothing to judge by
    label = fe.TARGETS["time"]
    nulls = x.withColumn(label, F.when(F.col(label) > 30, F.col(label))).withColumn(fe.TIME_FEATURES[0], F.lit(None).cast("double"))
    m = mo.fit_regressors(nulls, ["time"], patience=3, depth=2, min_rows=5, max_rounds=6)["time"]
    got = mo.point_predictions(x.withColumn(fe.TIME_FEATURES[0], F.lit(None).cast("double")), m, "time")
    assert got.where("pred_time IS NULL OR isnan(pred_time) OR pred_time < 30").count() == 0
