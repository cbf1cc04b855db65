"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (through the fixture views of
:mod:`shiplens.sources.tables`) so its work grows with them.  The matching
DuckDB text lives in :mod:`shiplens.plans.oracle_sql` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiplens.operators import summaries as su
from shiplens.plans.oracle_sql import ORACLE  # noqa: F401  (re-exported)
from shiplens.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str, source=tb.shipments):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(source(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


def register_raw(name: str):
    """Register a builder that takes (spark, sf_dir) itself."""
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# summaries
register("service_summary")(su.service_summary)
register("carrier_service_summary")(su.carrier_service_summary)
register("carrier_zone_summary")(su.carrier_zone_summary)
register("carrier_zone_percentile")(su.carrier_zone_percentile)
register("percentile_cube")(su.percentile_cube)
register("stored_percentile_cube")(su.stored_percentile_cube)
register("incremental_percentile_cube")(su.incremental_percentile_cube)
register("distribution_metadata")(su.distribution_metadata)
register("summary_rollup")(su.summary_rollup)

# distributions
from shiplens.operators import distributions as di  # noqa: E402

register("distribution_stats")(di.distribution_stats)
register("all_distributions")(di.all_distributions)
register("jarque_bera")(di.jarque_bera)
register("shapiro_wilk")(di.shapiro_wilk)
register("histogram")(di.histogram)
register("histogram_cost")(lambda s: di.histogram(s, "EXPRESS", 2, "shipping_cost", 12))
register("histogram_all_cells")(di.histogram_all_cells)

# comparisons and winners
from shiplens.operators import comparisons as co  # noqa: E402

register("compare_services_2sigma")(co.compare_services_2sigma)
register("compare_carriers")(co.compare_carriers)
register("compare_carriers_cost_zones")(lambda s: co.compare_carriers(s, [2, 5, 7], "shipping_cost_usd"))
register("carrier_winners")(co.carrier_winners)
register("zone_overall_winners")(co.zone_overall_winners)
register("carrier_win_tally")(co.carrier_win_tally)
register("best_service_percentile")(co.best_service_percentile)
register("carrier_grid_2sigma")(co.carrier_grid_2sigma)

# business-intelligence reports
from shiplens.operators import reports as rp  # noqa: E402

for _n in ("dow_pattern monthly_pattern service_trends flow_matrix carrier_dominance distance_performance "
           "size_impact weight_impact value_comparison value_service_counts carrier_scorecard "
           "carrier_consistency service_effectiveness cost_efficiency lane_profile lane_zscores iqr_outliers "
           "rare_combinations capacity_insights peak_days performance_trend cheapest_by_zone top_routes "
           "top_shipping_days comprehensive_report").split():
    register(_n)(getattr(rp, _n))
register("top_zip_routes", tb.lanes)(rp.top_zip_routes)

# data quality and profiles
from shiplens.operators import quality as qa  # noqa: E402

register("request_validation", tb.requests)(qa.request_validation)
register("rejected_requests", tb.requests)(lambda r: qa.split_valid(r)[1].select("request_id", "l_linenumber", "reasons"))
register("drop_missing_targets", tb.shipments_raw)(qa.drop_missing_targets)
register("dataset_profile", tb.shipments_raw)(qa.dataset_profile)
register("describe_targets", tb.shipments_raw)(qa.describe_targets)
register("service_value_counts")(qa.service_value_counts)
register("zone_value_counts")(qa.zone_value_counts)
register("training_profile")(qa.training_profile)

# row rules
from shiplens.operators import rules as ru  # noqa: E402

for _n in "calendar_features cyclical_features route_keys package_features zone_labels rate_residuals".split():
    register(_n)(getattr(ru, _n))
register("linear_rate_model")(ru.linear_rate_model_q)
register("zip_zone_lookup", tb.lanes)(ru.zip_zone_lookup)
register("zip_lane_zone", tb.lanes)(ru.zip_lane_zone)
for _n in "rate_card_lookup expected_transit expected_cost default_ship_date".split():
    register(_n, tb.requests)(getattr(ru, _n))
register_raw("distance_category_counts")(ru.distance_category_counts)

# feature pipeline
from shiplens.operators import features as fe  # noqa: E402

register("time_split")(fe.time_split_summary)
for _n in ("target_encoding serving_encodings target_encoded_rows route_30d_median feature_matrix_time "
           "feature_matrix_cost feature_matrix_zones").split():
    register(_n)(getattr(fe, _n))
register("carrier_quotes", tb.requests)(fe.carrier_quotes)
register_raw("request_history_features")(
    lambda spark, d: fe.request_history_features(tb.requests(spark, d), tb.shipments(spark, d)))
register_raw("serving_features_zone_only")(
    lambda spark, d: fe.serving_features_zone_only(tb.requests(spark, d), tb.shipments(spark, d)))

# streaming jobs: batch twins of the stream transformations
from shiplens.streaming import jobs as sj  # noqa: E402

register("daily_prediction_counts", tb.prediction_events)(sj.daily_prediction_counts)
register("prediction_stats", tb.prediction_events)(sj.prediction_stats)
register("response_time_stats", tb.prediction_events)(sj.response_time_stats)
register("stream_service_summary")(sj.stream_service_summary)
register("stream_score", tb.requests)(sj.score_requests)

# models (rows-only checks, except the route-median baseline)
from shiplens.operators import models as mo  # noqa: E402

register("baseline_eval")(mo.baseline_eval)
register_raw("model_eval")(lambda spark, d: mo.evaluate(mo.fitted_for(spark, d, quantiles=True)))
register_raw("zones_model_eval")(lambda spark, d: mo.evaluate(mo.zones_for(spark, d), ["zones"]))
register("lane_segments")(mo.lane_segments)
register("segment_summary")(mo.segment_summary)


@register_raw("train_time_model")
def _train_time(spark, d):
    """M7: time regressor fitted on the train split; predictions for every row."""
    f = mo.fitted_for(spark, d)
    return mo.point_predictions(f["training_table"], f["model_time"], "time").select(
        "l_orderkey", "l_linenumber", "split", "transit_time_days", "pred_time")


@register_raw("train_cost_model")
def _train_cost(spark, d):
    """M7: cost regressor fitted on the train split; predictions for every row."""
    f = mo.fitted_for(spark, d)
    return mo.point_predictions(f["training_table"], f["model_cost"], "cost").select(
        "l_orderkey", "l_linenumber", "split", "shipping_cost_usd", "pred_cost")


@register_raw("quantile_predictions")
def _quantiles(spark, d):
    """M8: q10/q50/q90 of both targets for the validation rows."""
    f = mo.fitted_for(spark, d, quantiles=True)
    out = f["training_table"].where("is_valid")
    for t in ("time", "cost"):
        out = mo.quantile_predictions(out, f[f"qmodel_{t}"], t)
    return out.select("l_orderkey", "l_linenumber", *[f"q{int(q * 100)}_{t}" for t in ("time", "cost")
                                                      for q in mo.QUANTILES])


register_raw("batch_predict")(lambda spark, d: mo.model_predictions_query(spark, d))
register_raw("predict_with_quantiles")(lambda spark, d: mo.model_predictions_query(spark, d, True))
register_raw("predict_transit_only")(
    lambda spark, d: mo.predict_transit_only(mo.model_predictions_query(spark, d)))
register_raw("predict_cost_only")(
    lambda spark, d: mo.predict_cost_only(mo.model_predictions_query(spark, d)))
register("batch_outcomes", tb.requests)(mo.batch_outcomes)
register("batch_summary", tb.requests)(mo.batch_summary)
