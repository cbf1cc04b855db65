"""Models: transit / cost regressors, quantile bounds, evaluation, scoring, lane segments
(M7-M12, E31, E32).

Regressors and quantile bounds are boosted trees (``operators/boosting.py``) fitted over a
feature table that is written once.  The bounds of one target are three ensembles with pinball
loss, as long as that target's regressor; a row's three values are put in order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions.quantiles import percentiles
from shiplens.functions.stats import COST, cnt, r6
from shiplens.operators import features as fe
from shiplens.operators.boosting import BoostedTrees, Head, boost
from shiplens.operators.reports import LANE_FEATURES, _lane_means
from shiplens.session import materialize

QUANTILES = (0.1, 0.5, 0.9)
# fixed values: leaves, sampling, bound and early stop of the boosted models
BOOST_PARAMS = dict(step=0.15, depth=6, min_rows=100, max_rounds=5000, patience=150, feature_share=0.8,
                    row_share=0.8, bag_every=5, seed=42)


def training_table(s: DataFrame) -> DataFrame:
    """M6 feature table (both targets), written once for the training iterations."""
    return materialize(fe.feature_table(s).withColumn("is_valid", F.col("split") == "valid"))


def fit_regressors(ft: DataFrame, targets=("time", "cost"), **overrides) -> dict[str, BoostedTrees]:
    """M7: boosted trees with absolute loss, by target; all targets share the passes over ``ft``.

    A target's rounds go on until the validation error has not improved for ``patience`` of
    them, ``max_rounds`` at most; the trees up to the best round are kept.
    """
    heads = [Head(t, fe.LABELS[t], fe.FEATURES[t]) for t in targets]
    return dict(zip(targets, boost(ft, heads, **dict(BOOST_PARAMS, **overrides))))


def fit_quantiles(ft: DataFrame, rounds: dict[str, int], **overrides) -> dict[str, list[BoostedTrees]]:
    """M8: ensembles with pinball loss for q10 / q50 / q90, by target, of ``rounds[target]`` trees each."""
    heads = [Head(f"q{int(q * 100)}_{t}", fe.LABELS[t], fe.FEATURES[t], quantile=q, rounds=n) for t, n in rounds.items() for q in QUANTILES]
    found = iter(boost(ft, heads, **dict(BOOST_PARAMS, **overrides)))
    return {t: [next(found) for _ in QUANTILES] for t in rounds}


def fit_quantile_tree(ft: DataFrame, target: str = "time", max_depth: int = 6,
                      min_rows: int = 100) -> tuple[PipelineModel, DataFrame]:
    """The simpler bounds M8 is judged against: one regression tree on the train rows and the
    exact q10/q50/q90 of the target in each leaf (Meinshausen 2006)."""
    label = fe.TARGETS[target]
    asm = VectorAssembler(inputCols=fe.FEATURES[target], outputCol="features", handleInvalid="keep")
    dt = DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=max_depth,
                               minInstancesPerNode=min_rows, leafCol=f"leaf_{target}", seed=42,
                               predictionCol=f"tree_{target}")
    train = ft.where(~F.col("is_valid"))
    model = Pipeline(stages=[asm, dt]).fit(train)
    leaves = model.transform(train).select(f"leaf_{target}", label)
    names = [f"q{int(q * 100)}_{target}" for q in QUANTILES]
    table = percentiles(leaves, [f"leaf_{target}"], label, list(QUANTILES), names)
    return model, table


def point_predictions(x: DataFrame, model: BoostedTrees, target: str) -> DataFrame:
    """``x`` with the column pred_<target>."""
    return x.withColumn(f"pred_{target}", model.column())


def quantile_predictions(x: DataFrame, models: list[BoostedTrees], target: str) -> DataFrame:
    """q10/q50/q90 of ``target`` for every row of ``x``, in order."""
    raw = F.array_sort(F.array(*[m.column() for m in models]))
    return x.withColumn("_q", raw).select(*x.columns, *[F.col("_q")[i].alias(f"q{int(q * 100)}_{target}") for i, q in enumerate(QUANTILES)])


def model_eval(s: DataFrame, **overrides) -> DataFrame:
    """M9: MAE / RMSE of both regressors on the validation rows; MAE, pinball loss and coverage
    of the quantile bounds."""
    ft = training_table(s)
    return evaluate(dict(fit_all(s, ft=ft, **overrides), training_table=ft))


def evaluate(f: dict, targets=("time", "cost")) -> DataFrame:
    """M9 on fitted artefacts (see :func:`fit_all`): every row is scored once, all figures come
    from one aggregate."""
    x = f["training_table"].where("is_valid")
    for t in targets:
        x = point_predictions(x, f[f"model_{t}"], t)
        x = quantile_predictions(x, f[f"qmodel_{t}"], t)
    cells = []
    for t in targets:
        label = F.col(fe.LABELS[t])
        for name, col, q in [("point", f"pred_{t}", None), *[(f"q{int(q * 100)}", f"q{int(q * 100)}_{t}", q) for q in QUANTILES]]:
            e = label - F.col(col)
            none = F.lit(None).cast("double")
            cells.append(F.struct(
                F.lit(t).alias("target"), F.lit(name).alias("model"), cnt().alias("n"), F.avg(F.abs(e)).alias("mae"),
                F.sqrt(F.avg(e * e)).alias("rmse"),
                (none if q is None else F.avg(F.greatest(F.lit(q) * e, F.lit(q - 1.0) * e))).alias("pinball"),
                (none if q is None else F.avg(F.when(label <= F.col(col), 1.0).otherwise(0.0))).alias("coverage")))
    out = x.agg(F.array(*cells).alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")
    return out.select("target", "model", "n", *[r6(c).alias(c) for c in ("mae", "rmse", "pinball", "coverage")])


def baseline_eval(s: DataFrame) -> DataFrame:
    """M9 baseline: the trailing 30-day route median used as the prediction, on the
    validation rows (MAE, RMSE per target)."""
    s = materialize(s)
    ks = materialize(fe.with_keys(fe.time_split(s)))
    v = fe.with_route_medians(ks, s).where(F.col("split") == "valid")
    outs = []
    for t, label in fe.TARGETS.items():
        e = F.col(label) - F.col(f"route_30d_median_{t}")
        outs.append(v.agg(F.lit(t).alias("target"), cnt().alias("n"), r6(F.avg(F.abs(e))).alias("mae"),
                          r6(F.sqrt(F.avg(e * e))).alias("rmse")))
    return outs[0].unionByName(outs[1])


# ------------------------------------------------------------------ scoring
def fit_all(s: DataFrame | None, ft: DataFrame | None = None, quantiles: bool = True, **overrides) -> dict:
    """Train everything the scorer needs: encodings, both regressors (``overrides`` of
    BOOST_PARAMS) and, with ``quantiles``, the bounds of both."""
    ft = training_table(s) if ft is None else ft
    enc = fe.encodings(fe.with_keys(ft.where(~F.col("is_valid"))), 200, 20)
    # what serving uses: softer smoothing, fitted on all history (M5)
    out = {"encodings": enc, "serving": fe.encodings(fe.with_keys(ft), 100, 10)}
    out |= {f"model_{t}": m for t, m in fit_regressors(ft, **overrides).items()}
    return out | (fit_bounds(ft, out, **overrides) if quantiles else {})


def fit_bounds(ft: DataFrame, models: dict, targets=("time", "cost"), **overrides) -> dict:
    """The quantile ensembles that belong to fitted regressors (at least one tree each)."""
    found = fit_quantiles(ft, {t: max(1, len(models[f"model_{t}"])) for t in targets}, **overrides)
    return {f"qmodel_{t}": m for t, m in found.items()}


def fit_zones(ft: DataFrame, **overrides) -> dict:
    """M6-M8 for requests without a package: transit days and their bounds from calendar, route
    history and encodings alone (12 features)."""
    out = {"model_zones": fit_regressors(ft, ["zones"], **overrides)["zones"]}
    return dict(out, **fit_bounds(ft, out, ["zones"], **overrides), training_table=ft)


def batch_predict(req: DataFrame, models: dict, quantiles: bool = False, history: DataFrame | None = None,
                  medians: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """M10 (and M12 with ``quantiles``): validate every request, build serving features, score
    both targets (rounded to 2 decimals); invalid rows get success = false.

    With a shipment ``history``, or its stored ``medians`` (``features.route_median_table``; what a
    stream uses): trailing route medians of M4 and the serving encodings of M5.  Without: the
    zone-only features of M13.
    """
    from shiplens.operators.quality import validation_reasons
    x = req.withColumn("reasons", validation_reasons())
    plain = history is None and medians is None
    f = fe.zone_only_features(x, models["encodings" if plain else "serving"], history, medians)
    for t in ("time", "cost"):
        f = point_predictions(f, models[f"model_{t}"], t)
        if quantiles:
            f = quantile_predictions(f, models[f"qmodel_{t}"], t)
    ok = F.col("reasons") == ""
    cols = [F.when(ok, F.round("pred_time", 2)).alias("predicted_transit_days"),
            F.when(ok, F.round("pred_cost", 2)).alias("predicted_cost_usd")]
    if quantiles:
        cols += [F.when(ok, F.round(f"q{int(q * 100)}_{t}", 2)).alias(f"{t}_q{int(q * 100)}")
                 for t in ("time", "cost") for q in QUANTILES]
    return f.select("request_id", "l_linenumber", ok.alias("success"), "reasons", *cols)


def batch_outcomes(req: DataFrame) -> DataFrame:
    """Which requests are scored, and why not.  Every valid request gets both predictions,
    so validation alone decides; no model is needed."""
    from shiplens.operators.quality import validation_reasons
    ok = F.col("reasons") == ""
    return req.withColumn("reasons", validation_reasons()).select(
        "request_id", "l_linenumber", ok.alias("success"), "reasons", ok.alias("has_transit"), ok.alias("has_cost"))


def predict_transit_only(pred: DataFrame) -> DataFrame:
    """Time-only projection of M10."""
    return pred.select("request_id", "l_linenumber", "success", "predicted_transit_days")


def predict_cost_only(pred: DataFrame) -> DataFrame:
    """Cost-only projection of M10."""
    return pred.select("request_id", "l_linenumber", "success", "predicted_cost_usd")


def batch_summary(req: DataFrame) -> DataFrame:
    """M10 envelope: count and successful count of a batch (see :func:`batch_outcomes`)."""
    return batch_outcomes(req).agg(cnt().alias("count"), F.sum(F.col("success").cast("long")).alias("successful_count"))


# ----------------------------------------------------------------- segments
SEGMENTS, RESTARTS, LLOYD_ROUNDS = 4, 10, 40


def _lloyd(k: int, rounds: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """One restart: its starting lanes follow from its number, then Lloyd's rounds until no lane moves."""
        pdf = pdf.sort_values(["origin_zone", "dest_zone"], kind="stable").reset_index(drop=True)
        x, n, r = pdf[[f"z_{c}" for c in LANE_FEATURES]].to_numpy(), len(pdf), int(pdf["restart"].iloc[0])
        centres, label = x[[(7 * r + j * n // min(k, n)) % n for j in range(min(k, n))]], None
        for _ in range(rounds):
            d = ((x[:, None, :] - centres) ** 2).sum(axis=2)
            moved = d.argmin(axis=1)                      # ties to the first centre
            if label is not None and (moved == label).all():
                break
            label = moved
            centres = np.array([x[label == j].mean(axis=0) if (label == j).any() else c for j, c in enumerate(centres)])
        d = ((x[:, None, :] - centres) ** 2).sum(axis=2)
        return pdf[["restart", "origin_zone", "dest_zone"]].assign(raw=d.argmin(axis=1).astype("int32"), inertia=float(d.min(axis=1).sum()))
    return run


def lane_segments(s: DataFrame, k: int = SEGMENTS, restarts: int = RESTARTS) -> DataFrame:
    """K-means on the population-standardised lane features (a feature without spread counts as 0).

    The restarts are keys of one job; each starts from lanes that its number names and sees one
    row per pair of zones.  The one with the least sum of squares (first of equals) is kept, and its
    segments are numbered 0..k-1 by ascending mean cost.
    """
    lp = materialize(_lane_means(s))                  # one row per pair of zones
    st = lp.agg(*[F.avg(c).alias(f"_m_{c}") for c in LANE_FEATURES],
                *[F.stddev_pop(c).alias(f"_s_{c}") for c in LANE_FEATURES])
    z = lp.crossJoin(F.broadcast(st)).select(
        "origin_zone", "dest_zone", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("restart"),
        *[F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(0.0).alias(f"z_{c}") for c in LANE_FEATURES])
    runs = z.groupBy("restart").applyInPandas(
        _lloyd(k, LLOYD_ROUNDS), "restart int, origin_zone int, dest_zone int, raw int, inertia double")
    best = runs.withColumn("_first", F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.round("inertia", 9), "restart"))).where("_first = 1")
    lab = lp.join(F.broadcast(best.select("origin_zone", "dest_zone", "raw")), ["origin_zone", "dest_zone"])
    mean = lab.groupBy("raw").agg(F.avg(COST).alias("_mc"))
    order = mean.withColumn("segment", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_mc", "raw")) - 1).cast("int"))
    return lab.join(F.broadcast(order.select("raw", "segment")), "raw").select(
        "origin_zone", "dest_zone", "segment", *[r6(c).alias(c) for c in LANE_FEATURES])


def segment_summary(s: DataFrame) -> DataFrame:
    """Mean of the four lane features and number of lanes per segment."""
    seg = lane_segments(s)
    return seg.groupBy("segment").agg(*[r6(F.avg(c)).alias(c) for c in LANE_FEATURES],
                                      cnt().alias("lanes"))


_TABLES: dict = {}
_FITTED: dict = {}
_ZONES: dict = {}


def _once(cache: dict, spark, sf_dir: str, make):
    """``make()`` once per (application, data folder); what an earlier session left is forgotten."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in cache:
        cache.clear()
        cache[key] = make()
    return cache[key]


def training_table_for(spark, sf_dir: str) -> DataFrame:
    """The feature table of ``sf_dir``, written once per application."""
    from shiplens.sources import tables as tb
    return _once(_TABLES, spark, sf_dir, lambda: training_table(tb.shipments(spark, sf_dir)))


def fitted_for(spark, sf_dir: str, quantiles: bool = False) -> dict:
    """Artefacts trained once per (application, data folder) and reused by the scoring queries:
    train once, score many; the quantile ensembles when first asked for.  They are models and
    written tables; nothing stays persisted."""
    def make():
        ft = training_table_for(spark, sf_dir)
        return dict(fit_all(None, ft=ft, quantiles=False), training_table=ft)
    found = _once(_FITTED, spark, sf_dir, make)
    if quantiles and "qmodel_time" not in found:
        found.update(fit_bounds(found["training_table"], found))
    return found


def model_predictions_query(spark, sf_dir: str, quantiles: bool = False) -> DataFrame:
    """Score the requests of ``sf_dir`` with models trained on its shipments (M10 / M12 query)."""
    from shiplens.sources import tables as tb
    return batch_predict(tb.requests(spark, sf_dir), fitted_for(spark, sf_dir, quantiles), quantiles,
                         history=tb.shipments(spark, sf_dir))


def zones_for(spark, sf_dir: str) -> dict:
    """The zones-only model and its bounds, trained once per (application, data folder)."""
    return _once(_ZONES, spark, sf_dir, lambda: fit_zones(training_table_for(spark, sf_dir)))
