"""DuckDB oracle SQL for the registered queries (independent formulation).

Every text is ``WITH <fixture views> SELECT ...`` over the driver tables.
Floats are rounded to 6 digits and counts cast to BIGINT on both sides;
doubles are written in e-notation so both engines type them as DOUBLE.
"""

from __future__ import annotations

from shiplens.plans.views import with_views

T, C = "transit_time_days", "shipping_cost_usd"


def r(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE) * 1e6) / 1e6)"


def eavg(x: str) -> str:
    """Mean from an exact DECIMAL(38,7) sum (same steps as the Spark side)."""
    return f"(CAST(sum(CAST({x} AS DECIMAL(38,7))) AS DOUBLE) / count({x}))"


def r9(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE) * 1e9) / 1e9)"


def q(expr: str, p: float) -> str:
    return f"quantile_cont({expr}, {p!r})"


ORACLE: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLE[name] = with_views(fn())
        return fn
    return deco


# ---------------------------------------------------------------- summaries
@oracle("service_summary")
def _e1():
    return f"""SELECT service_level, CAST(count(*) AS BIGINT) AS total_shipments,
 {r(eavg(T))} AS avg_transit_time, {r(eavg(C))} AS avg_cost,
 {r(f'stddev_samp({T})')} AS transit_time_std, {r(f'stddev_samp({C})')} AS cost_std,
 array_to_string(list_sort(list_distinct(list(dest_zone))), ',') AS zones_served
FROM shipments GROUP BY service_level"""


def _summary(keys: str, zones: bool, zone_alias: bool) -> str:
    sel = keys.replace("dest_zone", "dest_zone AS zone") if zone_alias else keys
    extra = ",\n array_to_string(list_sort(list_distinct(list(dest_zone))), ',') AS zones_served" if zones else ""
    return f"""SELECT {sel}, CAST(count(*) AS BIGINT) AS total_shipments,
 {r(eavg(T))} AS avg_transit_time, {r(eavg(C))} AS avg_cost,
 {r(f'stddev_samp({T})')} AS transit_time_std, {r(f'stddev_samp({C})')} AS cost_std,
 {r(q(T, 0.5))} AS median_transit_time, {r(q(C, 0.5))} AS median_cost{extra}
FROM shipments GROUP BY {keys}"""


@oracle("carrier_service_summary")
def _e2():
    return _summary("carrier, service_level", True, False)


@oracle("carrier_zone_summary")
def _e3():
    return _summary("carrier, service_level, dest_zone", False, True)


def percentile_filtered_sql(pcts, methods, with_pm: bool) -> str:
    parts = []
    for p in pcts:
        for m in methods:
            agg_t = q(T, 0.5) if m == "median" else f"CAST(sum(CAST({T} AS DECIMAL(38,7))) AS DOUBLE) / count({T})"
            agg_c = q(C, 0.5) if m == "median" else f"CAST(sum(CAST({C} AS DECIMAL(38,7))) AS DOUBLE) / count({C})"
            pm = f"CAST({float(p)!r} AS DOUBLE) AS percentile, '{m}' AS method, " if with_pm else ""
            parts.append(f"""SELECT carrier, service_level, dest_zone AS zone, {pm}
 CAST(max(n) AS BIGINT) AS total_shipments, CAST(count(*) AS BIGINT) AS records_in_percentile,
 {r('count(*) / max(n) * 100')} AS percentile_coverage, {r('max(thr)')} AS percentile_threshold,
 {r(agg_t)} AS avg_transit_time, {r(agg_t)} AS median_transit_time,
 {r(agg_c)} AS avg_cost, {r(agg_c)} AS median_cost,
 {r(f'stddev_samp({T})')} AS transit_time_std, {r(f'stddev_samp({C})')} AS cost_std
FROM (SELECT s.carrier, s.service_level, s.dest_zone, s.{T}, s.{C}, t.thr, t.n
      FROM shipments s JOIN (SELECT carrier, service_level, dest_zone, {q(T, p / 100.0)} AS thr,
                                    count(*) AS n FROM shipments GROUP BY carrier, service_level, dest_zone) t
        ON s.carrier = t.carrier AND s.service_level = t.service_level AND s.dest_zone = t.dest_zone
      WHERE s.{T} <= t.thr) k
GROUP BY carrier, service_level, dest_zone""")
    return "\nUNION ALL\n".join(parts)


@oracle("carrier_zone_percentile")
def _e4():
    return percentile_filtered_sql([50], ["median"], False)


@oracle("percentile_cube")
def _a12():
    return percentile_filtered_sql([50, 70, 80, 85, 90, 95], ["median", "mean"], True)


ORACLE["stored_percentile_cube"] = ORACLE["percentile_cube"]
ORACLE["incremental_percentile_cube"] = ORACLE["percentile_cube"]


@oracle("distribution_metadata")
def _a13():
    return f"""SELECT service_level, zone, metric, {r(eavg('v'))} AS mean, {r('stddev_samp(v)')} AS std,
 {r(q('v', 0.5))} AS median, {r('min(v)')} AS min, {r('max(v)')} AS max, CAST(count(v) AS BIGINT) AS count
FROM (SELECT service_level, dest_zone AS zone, 'transit_time' AS metric, {T} AS v FROM shipments
      UNION ALL SELECT service_level, dest_zone, 'shipping_cost', {C} FROM shipments) u
GROUP BY service_level, zone, metric"""


@oracle("summary_rollup")
def _e42():
    return f"""SELECT CASE WHEN grouping(carrier) = 1 THEN 'service' WHEN grouping(dest_zone) = 1 THEN 'carrier_service'
 ELSE 'carrier_service_zone' END AS level, carrier, service_level, dest_zone AS zone,
 CAST(count(*) AS BIGINT) AS total_shipments,
 {r(eavg(T))} AS avg_transit_time, {r(eavg(C))} AS avg_cost,
 {r(f'stddev_samp({T})')} AS transit_time_std, {r(f'stddev_samp({C})')} AS cost_std
FROM shipments
GROUP BY GROUPING SETS ((service_level), (carrier, service_level), (carrier, service_level, dest_zone))"""


# ------------------------------------------------------------ distributions
def skew_sql(v: str) -> str:
    return (f"((avg({v}*{v}*{v}) - 3e0*avg({v})*avg({v}*{v}) + 2e0*avg({v})*avg({v})*avg({v}))"
            f" / pow(var_pop({v}), 1.5e0))")


LONG = f"""(SELECT service_level, dest_zone AS zone, 'transit_time' AS metric, {T} AS v FROM shipments
      UNION ALL SELECT service_level, dest_zone, 'shipping_cost', {C} FROM shipments)"""

DIST_P = [("p10", 0.1), ("p20", 0.2), ("p30", 0.3), ("p40", 0.4), ("p60", 0.6), ("p70", 0.7),
          ("p80", 0.8), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)]


def dist_stats_sql() -> str:
    ps = ",\n ".join(f"{r9(q('v', p))} AS {n}" for n, p in DIST_P)
    return f"""SELECT service_level, zone, metric, CAST(count(v) AS BIGINT) AS count, {r(eavg('v'))} AS mean,
 {r9(q('v', 0.5))} AS median, {r('stddev_samp(v)')} AS std, {r('var_samp(v)')} AS var,
 {r('min(v)')} AS min, {r('max(v)')} AS max, {r9(q('v', 0.25))} AS q25, {r9(q('v', 0.75))} AS q75,
 {r9(q('v', 0.75) + ' - ' + q('v', 0.25))} AS iqr, {r(skew_sql('v'))} AS skewness,
 {r('kurtosis_pop(v)')} AS kurtosis, {ps}
FROM {LONG} u GROUP BY service_level, zone, metric"""


@oracle("distribution_stats")
def _e5():
    return dist_stats_sql()


@oracle("all_distributions")
def _e6():
    return f"""SELECT g.service_level, g.zone, g.metric, d.count, d.mean, d.median, d.std, d.var, d.min, d.max,
 d.q25, d.q75, d.iqr, d.skewness, d.kurtosis, {', '.join('d.' + n for n, _ in DIST_P)}
FROM (SELECT DISTINCT service_level FROM shipments) sv
CROSS JOIN (SELECT CAST(range AS INT) AS zone FROM range(1, 10)) z
CROSS JOIN (SELECT 'transit_time' AS metric UNION ALL SELECT 'shipping_cost') m
JOIN LATERAL (SELECT sv.service_level, z.zone, m.metric) g ON TRUE
LEFT JOIN ({dist_stats_sql()}) d
  ON d.service_level = g.service_level AND d.zone = g.zone AND d.metric = g.metric"""


@oracle("jarque_bera")
def _e7b():
    jb = f"(n / 6e0 * (S * S + K * K / 4e0))"
    return f"""SELECT service_level, zone, metric, n, {r(jb)} AS jb_statistic, {r(f'exp(-{jb} / 2e0)')} AS jb_p_value,
 exp(-{jb} / 2e0) > 5e-2 AS is_normal_p05
FROM (SELECT service_level, zone, metric, CAST(count(v) AS BIGINT) AS n, {skew_sql('v')} AS S,
             kurtosis_pop(v) AS K FROM {LONG} u GROUP BY service_level, zone, metric) t"""


def hist_sql(where: str, keys: list[str], bins: int, metric_col: str = T) -> str:
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    sel_keys = ", ".join(f"g.{x}" for x in keys)
    join_on = " AND ".join([f"b.{x} = g.{x}" for x in keys] + ["b.bin = g.bin"])
    rj = (" AND ".join(f"c.{x} = r2.{x}" for x in keys)) or "TRUE"
    cells = f"SELECT service_level, dest_zone AS zone, {metric_col} AS v FROM shipments WHERE {metric_col} IS NOT NULL{where}"
    return f"""WITH c AS ({cells}),
r AS (SELECT {kc}CASE WHEN min(v) = max(v) THEN min(v) - 5e-1 ELSE min(v) END AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 5e-1 ELSE max(v) END AS hi,
             count(*) AS n FROM c {'GROUP BY ' + k if keys else ''}),
r2 AS (SELECT *, (hi - lo) / {float(bins)!r} AS w FROM r),
b AS (SELECT {', '.join('c.' + x for x in keys) + ', ' if keys else ''}least(CAST(floor((v - lo) / w) AS INT) + 1, {bins}) AS bin,
             count(*) AS cnt FROM c JOIN r2 ON {rj} GROUP BY ALL),
g AS (SELECT r2.*, CAST(s.range AS INT) AS bin FROM r2 CROSS JOIN range(1, {bins + 1}) s)
SELECT {sel_keys + ', ' if keys else ''}g.bin, {r('g.lo + (g.bin - 5e-1) * g.w')} AS bin_center,
 CAST(coalesce(b.cnt, 0) AS BIGINT) AS count, {r('g.w')} AS bin_width, CAST(g.n AS BIGINT) AS total_count
FROM g LEFT JOIN b ON {join_on}"""


@oracle("histogram")
def _e14():
    return hist_sql(" AND service_level = 'STANDARD' AND dest_zone = 5", [], 30)


@oracle("histogram_cost")
def _e14_cost():
    return hist_sql(" AND service_level = 'EXPRESS' AND dest_zone = 2", [], 12, C)


@oracle("histogram_all_cells")
def _e15():
    return hist_sql("", ["service_level", "zone"], 30)


# ------------------------------------------------------------- comparisons
@oracle("compare_services_2sigma")
def _e8():
    return f"""WITH g AS (SELECT dest_zone AS zone, service_level, count(*) AS n, {eavg(T)} AS mean,
                  stddev_samp({T}) AS std FROM shipments GROUP BY dest_zone, service_level),
h AS (SELECT *, mean - 2e0 * std AS lower_2sigma, mean + 2e0 * std AS upper_2sigma, 4e0 * std AS range_2sigma,
             mean - 1.96e0 * std / sqrt(n) AS ci95_low, mean + 1.96e0 * std / sqrt(n) AS ci95_high FROM g),
w AS (SELECT zone, service_level AS winner FROM (SELECT zone, service_level, row_number() OVER (
        PARTITION BY zone ORDER BY upper_2sigma, service_level) AS rn FROM h WHERE upper_2sigma IS NOT NULL) x
      WHERE rn = 1)
SELECT h.zone, h.service_level, CAST(h.n AS BIGINT) AS n, {r('mean')} AS mean, {r('std')} AS std,
 {r('lower_2sigma')} AS lower_2sigma, {r('upper_2sigma')} AS upper_2sigma, {r('range_2sigma')} AS range_2sigma,
 {r('ci95_low')} AS ci95_low, {r('ci95_high')} AS ci95_high, w.winner = h.service_level AS is_winner
FROM h LEFT JOIN w ON h.zone = w.zone"""


def carrier_stats_sql(v: str, where: str = "") -> str:
    return f"""SELECT dest_zone AS zone, service_level, carrier, count({v}) AS sample_size, {eavg(v)} AS mean,
  {q(v, 0.5)} AS median, stddev_samp({v}) AS std, {q(v, 0.25)} AS q25, {q(v, 0.75)} AS q75,
  {eavg(v)} - 2e0 * stddev_samp({v}) AS lower_2sigma, {eavg(v)} + 2e0 * stddev_samp({v}) AS upper_2sigma,
  1e0 / (stddev_samp({v}) + 1e-1) AS reliability_score
FROM shipments {where} GROUP BY dest_zone, service_level, carrier HAVING count({v}) > 5"""


CARRIER_STATS = carrier_stats_sql(T)


def _compare_sql(stats: str) -> str:
    cols = ", ".join(f"{r(c)} AS {c}" for c in ("mean", "median", "std", "q25", "q75", "lower_2sigma",
                                                 "upper_2sigma", "reliability_score"))
    return f"SELECT zone, service_level, carrier, CAST(sample_size AS BIGINT) AS sample_size, {cols} FROM ({stats}) c"


@oracle("compare_carriers")
def _e9():
    return _compare_sql(CARRIER_STATS)


@oracle("compare_carriers_cost_zones")
def _e9_cost():
    return _compare_sql(carrier_stats_sql(C, "WHERE dest_zone IN (2, 5, 7)"))


CARRIER_WINNERS = f"""WITH c AS ({CARRIER_STATS}),
m AS (SELECT *, row_number() OVER (PARTITION BY zone, service_level ORDER BY median, carrier) AS rm,
             row_number() OVER (PARTITION BY zone, service_level ORDER BY upper_2sigma NULLS LAST, carrier) AS ru
      FROM c),
cw AS (SELECT zone, service_level, CAST(count(*) AS BIGINT) AS carriers_compared,
  max(CASE WHEN rm = 1 THEN carrier END) AS winner_median,
  max(CASE WHEN rm = 1 THEN median END) AS wm_value, avg(median) AS avg_median,
  max(CASE WHEN ru = 1 AND upper_2sigma IS NOT NULL THEN carrier END) AS winner_2sigma,
  max(CASE WHEN ru = 1 THEN upper_2sigma END) AS w2_value,
  max(CASE WHEN ru = 1 AND upper_2sigma IS NOT NULL THEN median END) AS w2_median,
  max(CASE WHEN ru = 1 AND upper_2sigma IS NOT NULL THEN std END) AS w2_std,
  avg(upper_2sigma) AS avg_upper
FROM m GROUP BY zone, service_level)"""


@oracle("carrier_winners")
def _e10():
    return CARRIER_WINNERS + f"""
SELECT zone, service_level, carriers_compared, winner_median, {r('wm_value')} AS winner_median_value,
 {r('avg_median - wm_value')} AS winner_median_advantage, winner_2sigma, {r('w2_value')} AS winner_2sigma_value,
 {r('w2_median')} AS winner_2sigma_median, {r('w2_std')} AS winner_2sigma_std,
 {r('avg_upper - w2_value')} AS winner_2sigma_advantage, winner_median AS winner FROM cw"""


ZONE_WINNERS = f"""zc AS (SELECT *, median / reliability_score AS score FROM ({CARRIER_STATS}) c0
       WHERE median IS NOT NULL AND upper_2sigma IS NOT NULL AND reliability_score IS NOT NULL),
zr AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY score, carrier, service_level) AS r1,
              row_number() OVER (PARTITION BY zone ORDER BY upper_2sigma, carrier, service_level) AS r2 FROM zc),
zw AS (SELECT zone,
  max(CASE WHEN r1 = 1 THEN carrier END) AS median_carrier, max(CASE WHEN r1 = 1 THEN service_level END) AS median_service_level,
  max(CASE WHEN r1 = 1 THEN median END) AS median_value, max(CASE WHEN r1 = 1 THEN reliability_score END) AS median_reliability,
  max(CASE WHEN r2 = 1 THEN carrier END) AS sigma_carrier, max(CASE WHEN r2 = 1 THEN service_level END) AS sigma_service_level,
  max(CASE WHEN r2 = 1 THEN upper_2sigma END) AS sigma_upper_2sigma, max(CASE WHEN r2 = 1 THEN median END) AS sigma_median,
  max(CASE WHEN r2 = 1 THEN std END) AS sigma_std
FROM zr GROUP BY zone)"""


@oracle("zone_overall_winners")
def _e11():
    return "WITH " + ZONE_WINNERS + f"""
SELECT zone, median_carrier, median_service_level, {r('median_value')} AS median_value,
 {r('median_reliability')} AS median_reliability, sigma_carrier, sigma_service_level,
 {r('sigma_upper_2sigma')} AS sigma_upper_2sigma, {r('sigma_median')} AS sigma_median, {r('sigma_std')} AS sigma_std
FROM zw"""


@oracle("carrier_win_tally")
def _e12():
    return CARRIER_WINNERS + ",\n" + ZONE_WINNERS + """,
wins AS (SELECT 'cell_median' AS kind, winner_median AS carrier, CAST(NULL AS VARCHAR) AS service_level FROM cw
  UNION ALL SELECT 'cell_2sigma', winner_2sigma, NULL FROM cw
  UNION ALL SELECT 'zone_median', median_carrier, NULL FROM zw
  UNION ALL SELECT 'zone_2sigma', sigma_carrier, NULL FROM zw
  UNION ALL SELECT 'combo_median', winner_median, service_level FROM cw
  UNION ALL SELECT 'combo_2sigma', winner_2sigma, service_level FROM cw),
t AS (SELECT kind, carrier, service_level, CAST(count(*) AS BIGINT) AS wins FROM wins GROUP BY kind, carrier, service_level)
SELECT kind, carrier, service_level, wins,
 row_number() OVER (PARTITION BY kind ORDER BY wins DESC, carrier, service_level NULLS FIRST) = 1 AS is_top FROM t"""


@oracle("best_service_percentile")
def _e13():
    p = 80
    return f"""WITH t AS (SELECT dest_zone, service_level, {q(T, p / 100.0)} AS thr, count(*) AS n FROM shipments
                GROUP BY dest_zone, service_level),
k AS (SELECT s.dest_zone, s.service_level, s.{T}, t.thr, t.n FROM shipments s JOIN t
        ON s.dest_zone = t.dest_zone AND s.service_level = t.service_level WHERE s.{T} <= t.thr),
a AS (SELECT dest_zone AS zone, service_level, {r(q(T, 0.5))} AS metric_value, {r('max(thr)')} AS percentile_threshold,
        CAST(count(*) AS BIGINT) AS records_in_percentile, CAST(max(n) AS BIGINT) AS total_shipments,
        {r('count(*) / max(n) * 100')} AS percentile_coverage, 'median' AS method FROM k GROUP BY dest_zone, service_level),
w AS (SELECT zone, service_level AS winner FROM (SELECT zone, service_level, row_number() OVER (
        PARTITION BY zone ORDER BY metric_value, service_level) AS rn FROM a WHERE metric_value IS NOT NULL) x WHERE rn = 1)
SELECT a.*, w.winner = a.service_level AS is_winner FROM a LEFT JOIN w ON a.zone = w.zone"""


@oracle("carrier_grid_2sigma")
def _p20():
    e4 = percentile_filtered_sql([50], ["median"], False)
    return f"""WITH e AS ({e4}),
g AS (SELECT carrier, service_level, zone, median_transit_time AS metric_value, transit_time_std AS std,
        greatest(0e0, median_transit_time - 2e0 * transit_time_std) AS lower,
        median_transit_time + 2e0 * transit_time_std AS upper FROM e),
w AS (SELECT service_level, zone, carrier AS winner FROM (SELECT service_level, zone, carrier, row_number() OVER (
        PARTITION BY service_level, zone ORDER BY metric_value, carrier) AS rn FROM g WHERE metric_value IS NOT NULL) x
      WHERE rn = 1)
SELECT g.carrier, g.service_level, g.zone, g.metric_value, g.std, {r('g.lower')} AS lower, {r('g.upper')} AS upper,
 w.winner = g.carrier AS is_winner
FROM g LEFT JOIN w ON g.service_level = w.service_level AND g.zone = w.zone"""


# ----------------------------------------------------------------- reports
def _pattern(key_sql: str, alias: str) -> str:
    return f"""SELECT {key_sql} AS {alias}, {r(eavg(T))} AS {T}_mean, {r(f'stddev_samp({T})')} AS {T}_std,
 CAST(count({T}) AS BIGINT) AS {T}_count, {r(eavg(C))} AS {C}_mean, {r(f'stddev_samp({C})')} AS {C}_std
FROM shipments GROUP BY {key_sql}"""


@oracle("dow_pattern")
def _e16():
    return _pattern("dayname(ship_date)", "day_of_week")


@oracle("monthly_pattern")
def _e17():
    return _pattern("CAST(month(ship_date) AS INT)", "month")


def _share_sql(row: str, col: str, rn: str, cn: str, pct: bool) -> str:
    tail = (f"{r('coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY g.' + rn + ') * 1e2')} AS share_pct"
            if pct else "CAST(coalesce(c.n, 0) AS BIGINT) AS count")
    return f"""WITH c AS (SELECT {row} AS {rn}, {col} AS {cn}, count(*) AS n FROM shipments GROUP BY 1, 2),
g AS (SELECT a.{rn}, b.{cn} FROM (SELECT DISTINCT {rn} FROM c) a CROSS JOIN (SELECT DISTINCT {cn} FROM c) b)
SELECT g.{rn}, g.{cn}, {tail} FROM g LEFT JOIN c ON g.{rn} = c.{rn} AND g.{cn} = c.{cn}"""


@oracle("service_trends")
def _e18():
    return _share_sql("CAST(month(ship_date) AS INT)", "service_level", "month", "service_level", True)


@oracle("flow_matrix")
def _e19():
    return _share_sql("origin_zone", "dest_zone", "origin_zone", "dest_zone", False)


@oracle("carrier_dominance")
def _e20():
    return _share_sql("dest_zone", "carrier", "dest_zone", "carrier", True)


@oracle("distance_performance")
def _e21():
    return f"""SELECT zone_distance, row_number() OVER (ORDER BY n DESC, zone_distance) = 1 AS is_most_common,
 {r('tm')} AS {T}_mean, {r('ts')} AS {T}_std, {r('cm')} AS {C}_mean, {r('cs')} AS {C}_std, n
FROM (SELECT abs(dest_zone - origin_zone) AS zone_distance, {eavg(T)} AS tm, stddev_samp({T}) AS ts,
             {eavg(C)} AS cm, stddev_samp({C}) AS cs, CAST(count(*) AS BIGINT) AS n FROM shipments GROUP BY 1) t"""


PKG_CAT = """CASE WHEN package_volume_cubic_in <= 0 THEN NULL WHEN package_volume_cubic_in <= 100 THEN 'Small'
 WHEN package_volume_cubic_in <= 500 THEN 'Medium' WHEN package_volume_cubic_in <= 1000 THEN 'Large'
 WHEN package_volume_cubic_in IS NOT NULL THEN 'XLarge' END"""


@oracle("size_impact")
def _e22():
    return f"""WITH x AS (SELECT {PKG_CAT} AS package_category, {T}, {C} FROM shipments),
g AS (SELECT package_category, {eavg(T)} AS tm, stddev_samp({T}) AS ts, {eavg(C)} AS cm, stddev_samp({C}) AS cs,
             CAST(count(*) AS BIGINT) AS n, {q(C, 0.5)} AS cmed FROM x WHERE package_category IS NOT NULL GROUP BY 1),
cats AS (SELECT * FROM (VALUES ('Small'), ('Medium'), ('Large'), ('XLarge')) v(package_category))
SELECT cats.package_category, {r('tm')} AS {T}_mean, {r('ts')} AS {T}_std, {r('cm')} AS {C}_mean,
 {r('cs')} AS {C}_std, CAST(coalesce(n, 0) AS BIGINT) AS n, {r('cmed')} AS {C}_median
FROM cats LEFT JOIN g ON cats.package_category = g.package_category"""


@oracle("weight_impact")
def _e23():
    return f"""WITH rg AS (SELECT min(package_weight_lbs) AS mn, max(package_weight_lbs) AS mx FROM shipments),
x AS (SELECT s.{T}, s.{C}, CASE WHEN (rg.mx - rg.mn) / 1e1 = 0 THEN 1 ELSE
        least(10, greatest(1, CAST(ceil((s.package_weight_lbs - rg.mn) / ((rg.mx - rg.mn) / 1e1)) AS INT))) END AS bin
      FROM shipments s CROSS JOIN rg),
g AS (SELECT bin, {eavg(C)} AS cm, stddev_samp({C}) AS cs, {eavg(T)} AS tm, stddev_samp({T}) AS ts,
             CAST(count(*) AS BIGINT) AS n FROM x GROUP BY bin),
grid AS (SELECT CAST(b.range AS INT) AS bin,
  CASE WHEN b.range = 1 THEN rg.mn - (rg.mx - rg.mn) * 1e-3 ELSE rg.mn + (b.range - 1) * ((rg.mx - rg.mn) / 1e1) END AS lft,
  CASE WHEN b.range = 10 THEN rg.mx ELSE rg.mn + b.range * ((rg.mx - rg.mn) / 1e1) END AS rgt
  FROM range(1, 11) b CROSS JOIN rg)
SELECT grid.bin, CAST(round(lft * 1e1) / 1e1 AS VARCHAR) || '-' || CAST(round(rgt * 1e1) / 1e1 AS VARCHAR) AS weight_range,
 {r('cm')} AS {C}_mean, {r('cs')} AS {C}_std, {r('tm')} AS {T}_mean, {r('ts')} AS {T}_std,
 CAST(coalesce(n, 0) AS BIGINT) AS n
FROM grid LEFT JOIN g ON grid.bin = g.bin"""


BAND = "CASE WHEN insurance_value > 500 THEN 'high_value' WHEN insurance_value <= 500 THEN 'regular_value' END"


@oracle("value_comparison")
def _e24a():
    return f"""SELECT {BAND} AS value_band, CAST(count(*) AS BIGINT) AS n, {r(eavg(T))} AS avg_transit,
 {r(eavg(C))} AS avg_cost FROM shipments WHERE {BAND} IS NOT NULL GROUP BY 1"""


@oracle("value_service_counts")
def _e24b():
    return f"""SELECT {BAND} AS value_band, service_level, CAST(count(*) AS BIGINT) AS n FROM shipments
WHERE {BAND} IS NOT NULL GROUP BY 1, 2"""


def _scorecard_sql(key: str, count: bool) -> str:
    n = ", CAST(count(*) AS BIGINT) AS n" if count else ""
    return f"""SELECT {key}, {r(eavg(T))} AS {T}_mean, {r(f'stddev_samp({T})')} AS {T}_std,
 {r(eavg(C))} AS {C}_mean, {r(f'stddev_samp({C})')} AS {C}_std{n},
 {r(q(T, 0.5))} AS {T}_median, {r(q(C, 0.5))} AS {C}_median FROM shipments GROUP BY {key}"""


@oracle("carrier_scorecard")
def _e25():
    return _scorecard_sql("carrier", True)


@oracle("carrier_consistency")
def _e26():
    return f"SELECT carrier, {r(f'stddev_samp({T}) / {eavg(T)}')} AS consistency_index FROM shipments GROUP BY carrier"


@oracle("service_effectiveness")
def _e27():
    return _scorecard_sql("service_level", False)


@oracle("cost_efficiency")
def _e28():
    return f"""SELECT carrier, service_level, {r(f'avg({C} / nullif({T}, 0e0))')} AS cost_per_day
FROM shipments GROUP BY carrier, service_level"""


LANE_F = [C, T, "package_weight_lbs", "insurance_value"]


@oracle("lane_profile")
def _e29():
    cols = ", ".join(f"{r(eavg(c))} AS {c}" for c in LANE_F)
    return f"SELECT origin_zone, dest_zone, {cols}, CAST(count(*) AS BIGINT) AS n FROM shipments GROUP BY 1, 2"


@oracle("lane_zscores")
def _e30():
    cols = ", ".join(f"{eavg(c)} AS {c}" for c in LANE_F)
    z = ", ".join(f"{r(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS z_{c}" for c in LANE_F)
    return f"SELECT origin_zone, dest_zone, {z} FROM (SELECT origin_zone, dest_zone, {cols} FROM shipments GROUP BY 1, 2) lp"


def segments_sql(k: int = 4, restarts: int = 10, rounds: int = 40) -> str:
    """CTEs up to ``seg`` (origin_zone, dest_zone, segment, features): Lloyd's rounds, one after the other."""
    x = [f"x{i}" for i in range(len(LANE_F))]
    cols = ", ".join(f"{eavg(c)} AS {c}" for c in LANE_F)
    z = ", ".join(f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0e0 END AS {v}" for c, v in zip(LANE_F, x))
    dist = " + ".join(f"(z.{v} - c.{v}) * (z.{v} - c.{v})" for v in x)
    parts = [f"lp AS MATERIALIZED (SELECT origin_zone, dest_zone, {cols} FROM shipments GROUP BY 1, 2)",
             f"z AS MATERIALIZED (SELECT *, {z}, row_number() OVER (ORDER BY origin_zone, dest_zone) - 1 AS i, count(*) OVER () AS n FROM lp)",
             f"""c0 AS MATERIALIZED (SELECT r.r, j.j, {', '.join('z.' + v for v in x)} FROM range({restarts}) r(r) CROSS JOIN range({k}) j(j)
  JOIN z ON z.i = (7 * r.r + j.j * z.n // least({k}, z.n)) % z.n WHERE j.j < z.n)"""]
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (SELECT r, j, d, i, {', '.join(x)} FROM (SELECT c.r, c.j, z.i, {', '.join('z.' + v for v in x)}, {dist} AS d,
  row_number() OVER (PARTITION BY c.r, z.i ORDER BY {dist}, c.j) AS k FROM c{t} c CROSS JOIN z) w WHERE k = 1)""")
        if t < rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (SELECT c.r, c.j, {', '.join(f'coalesce(m.{v}, c.{v}) AS {v}' for v in x)} FROM c{t} c
  LEFT JOIN (SELECT r, j, {', '.join(f'avg({v}) AS {v}' for v in x)} FROM a{t} GROUP BY r, j) m ON m.r = c.r AND m.j = c.j)""")
    parts += [f"best AS (SELECT r FROM a{rounds} GROUP BY r ORDER BY round(sum(d), 9), r LIMIT 1)",
              f"lab AS (SELECT z.*, a.j FROM a{rounds} a JOIN best ON best.r = a.r JOIN z ON z.i = a.i)",
              "num AS (SELECT j, row_number() OVER (ORDER BY mc, j) - 1 AS segment FROM (SELECT j, avg(shipping_cost_usd) AS mc FROM lab GROUP BY j) q)",
              f"seg AS (SELECT origin_zone, dest_zone, CAST(segment AS INTEGER) AS segment, {', '.join(f'{r(c)} AS {c}' for c in LANE_F)} "
              "FROM lab JOIN num ON num.j = lab.j)"]
    return ", ".join(parts)


@oracle("lane_segments")
def _e31():
    return f"WITH {segments_sql()} SELECT * FROM seg"


@oracle("segment_summary")
def _e32():
    return f"""WITH {segments_sql()} SELECT segment, {', '.join(f'{r(f"avg({c})")} AS {c}' for c in LANE_F)}, count(*) AS lanes
FROM seg GROUP BY segment"""


@oracle("shapiro_wilk")
def _e7a():
    from shiplens.functions.stats import normal_quantile, normal_upper
    poly = lambda cs, x: " + ".join(f"({float(c)!r}e0) * power({x}, {k})" for k, c in enumerate(cs))
    # fixed values: AS R94 polynomials
    last, second = poly([0, .221157, -.147981, -2.07119, 4.434685, -2.706056], "u"), poly([0, .042981, -.293762, -1.752461, 5.682633, -3.582633], "u")
    gamma = "(-2.273e0 + 0.459e0 * n)"
    few = f"(-ln({gamma} - ln(1 - w)) - ({poly([.544, -.39978, .025054, -.0006714], 'n')})) / exp({poly([1.3822, -.77857, .062767, -.0020322], 'n')})"
    many = f"(ln(1 - w) - ({poly([-1.5861, -.31082, -.083751, .0038915], 'ln(n)')})) / exp({poly([-.4803, -.082676, .0030302], 'ln(n)')})"
    return f"""WITH l AS (SELECT service_level, dest_zone AS zone, 'transit_time' AS metric, {T} AS v, l_orderkey, l_linenumber FROM shipments
  UNION ALL SELECT service_level, dest_zone, 'shipping_cost', {C}, l_orderkey, l_linenumber FROM shipments),
h AS (SELECT *, md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), metric)) AS h FROM l WHERE v IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY service_level, zone, metric ORDER BY h, v) AS k FROM h),
o AS (SELECT *, row_number() OVER (PARTITION BY service_level, zone, metric ORDER BY v, h) AS i,
        count(*) OVER (PARTITION BY service_level, zone, metric) AS n FROM k WHERE k <= 5000),
pp AS (SELECT *, (i - 0.375e0) / (n + 0.25e0) AS p FROM o),
m AS (SELECT *, {normal_quantile('p')} AS m FROM pp),
a AS (SELECT service_level, zone, metric, max(n) AS n, 1e0 / sqrt(max(n)) AS u, sqrt(sum(m * m)) AS len, list(v ORDER BY i) AS x, list(m ORDER BY i) AS ms,
        sum(m * m) AS mm, sum(m * v) AS mx, var_pop(v) * count(*) AS ss FROM m GROUP BY 1, 2, 3),
b AS (SELECT *, x[-1] - x[1] AS d1, x[-2] - x[2] AS d2, ms[-1] AS e1, ms[-2] AS e2, ms[-1] / len + {last} AS an, ms[-2] / len + {second} AS an1 FROM a),
c AS (SELECT *, CASE WHEN n < 3 OR d1 <= 0 THEN NULL WHEN n = 3 THEN sqrt(0.5e0) * d1
        WHEN n <= 5 THEN (mx - e1 * d1) * sqrt((1 - 2 * an * an) / (mm - 2 * e1 * e1)) + an * d1
        ELSE (mx - e1 * d1 - e2 * d2) * sqrt((1 - 2 * an * an - 2 * an1 * an1) / (mm - 2 * e1 * e1 - 2 * e2 * e2)) + an * d1 + an1 * d2 END AS s FROM b),
w AS (SELECT *, least(1e0, s * s / ss) AS w FROM c),
z AS (SELECT *, CASE WHEN w IS NULL OR w >= 1 THEN NULL WHEN n <= 11 THEN CASE WHEN {gamma} - ln(1 - w) > 0 THEN {few} END ELSE {many} END AS z FROM w),
f AS (SELECT *, CASE WHEN s IS NULL THEN NULL WHEN n = 3 THEN least(1e0, greatest(0e0, 6 / pi() * (asin(sqrt(w)) - asin(sqrt(0.75e0)))))
        WHEN w >= 1 THEN 1e0 WHEN z IS NULL THEN 0e0 ELSE {normal_upper('z')} END AS p FROM z)
SELECT service_level, zone, metric, CAST(n AS BIGINT) AS n_sample, {r('CASE WHEN s IS NOT NULL THEN w END')} AS shapiro_wilk_statistic,
  {r('p')} AS shapiro_wilk_p_value, coalesce(p > 0.05, false) AS is_normal_p05 FROM f"""


@oracle("iqr_outliers")
def _e33():
    return f"""WITH l AS (SELECT 'transit_time' AS metric, {T} AS v FROM shipments UNION ALL
                SELECT 'shipping_cost', {C} FROM shipments),
qq AS (SELECT metric, {q('v', 0.25)} AS q1, {q('v', 0.75)} AS q3 FROM l GROUP BY metric),
f AS (SELECT metric, q1, q3, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM qq),
j AS (SELECT l.metric, l.v, f.lo, f.hi, (l.v < f.lo OR l.v > f.hi) AS o, greatest(f.lo - l.v, l.v - f.hi) AS ex
      FROM l JOIN f ON l.metric = f.metric),
a AS (SELECT metric, count(*) AS n, CAST(sum(CASE WHEN o THEN 1 ELSE 0 END) AS BIGINT) AS oc FROM j GROUP BY metric),
t AS (SELECT metric, v, ex, row_number() OVER (PARTITION BY metric ORDER BY ex DESC, v DESC) AS rk FROM j WHERE o),
e AS (SELECT metric, string_agg(CAST(round(v * 1e6) / 1e6 AS VARCHAR), ',' ORDER BY ex DESC, v DESC) AS examples
      FROM t WHERE rk <= 10 GROUP BY metric)
SELECT f.metric, {r9('f.q1')} AS q1, {r9('f.q3')} AS q3, {r9('f.lo')} AS lower_fence, {r9('f.hi')} AS upper_fence,
 a.oc AS outlier_count, {r('a.oc / a.n * 1e2')} AS outlier_pct, e.examples
FROM f JOIN a ON f.metric = a.metric LEFT JOIN e ON f.metric = e.metric"""


@oracle("rare_combinations")
def _e34():
    return f"""WITH c AS (SELECT carrier, service_level, CAST(count(*) AS BIGINT) AS n FROM shipments GROUP BY 1, 2),
t AS (SELECT {q('n', 0.1)} AS thr FROM c)
SELECT carrier, service_level, n, {r('thr')} AS threshold FROM c, t WHERE n < thr"""


DAILY = f"""d AS (SELECT ship_date, CAST(count(*) AS BIGINT) AS volume FROM shipments GROUP BY ship_date),
t AS (SELECT {q('volume', 0.9)} AS thr FROM d)"""


@oracle("capacity_insights")
def _e35():
    return f"""WITH {DAILY}
SELECT {r('avg(volume)')} AS avg_daily_volume, {r('max(thr)')} AS peak_threshold,
 CAST(sum(CASE WHEN volume > thr THEN 1 ELSE 0 END) AS BIGINT) AS stress_days, CAST(count(*) AS BIGINT) AS active_days
FROM d, t"""


@oracle("peak_days")
def _e36():
    return f"WITH {DAILY}\nSELECT ship_date, volume FROM d, t WHERE volume > thr"


TREND = f"""m AS (SELECT CAST(month(ship_date) AS INT) AS month, {eavg(T)} AS mt FROM shipments GROUP BY 1),
p AS (SELECT mt, CAST(row_number() OVER (ORDER BY month) - 1 AS DOUBLE) AS pos FROM m),
tr AS (SELECT regr_slope(mt, pos) AS slope, CAST(count(*) AS BIGINT) AS months FROM p)"""


@oracle("performance_trend")
def _e37():
    return f"""WITH {TREND}
SELECT {r('slope')} AS trend_slope, months, CASE WHEN slope > 1e-1 THEN 'High' ELSE 'Low' END AS degradation_risk,
 CASE WHEN slope < 0 THEN 'Improving' ELSE 'Declining' END AS trend FROM tr"""


@oracle("cheapest_by_zone")
def _e38():
    return f"""WITH g AS (SELECT dest_zone, carrier, {eavg(C)} AS mc FROM shipments GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY dest_zone ORDER BY mc, carrier) AS lo,
             row_number() OVER (PARTITION BY dest_zone ORDER BY mc DESC, carrier) AS hi FROM g)
SELECT dest_zone AS zone, max(CASE WHEN lo = 1 THEN carrier END) AS cheapest_carrier,
 max(CASE WHEN hi = 1 THEN carrier END) AS most_expensive_carrier,
 {r('max(CASE WHEN hi = 1 THEN mc END) - max(CASE WHEN lo = 1 THEN mc END)')} AS potential_savings
FROM k GROUP BY dest_zone"""


@oracle("top_routes")
def _e39a():
    return """SELECT CAST(origin_zone AS VARCHAR) || '->' || CAST(dest_zone AS VARCHAR) AS route, CAST(count(*) AS BIGINT) AS n
FROM shipments GROUP BY 1 ORDER BY n DESC, route LIMIT 10"""


@oracle("top_zip_routes")
def _e39b():
    return """SELECT origin_zip || '->' || dest_zip AS route, CAST(count(*) AS BIGINT) AS n
FROM lanes GROUP BY 1 ORDER BY n DESC, route LIMIT 10"""


@oracle("top_shipping_days")
def _e40():
    return """SELECT dayname(ship_date) AS day_of_week, CAST(count(*) AS BIGINT) AS n FROM shipments
GROUP BY 1 ORDER BY n DESC, day_of_week LIMIT 3"""


@oracle("comprehensive_report")
def _e41():
    return f"""WITH {TREND}, {segments_sql()},
days AS (SELECT dayname(ship_date) AS k, count(*) AS n FROM shipments GROUP BY 1 ORDER BY n DESC, k LIMIT 3),
dist AS (SELECT abs(dest_zone - origin_zone) AS k, count(*) AS n FROM shipments GROUP BY 1 ORDER BY n DESC, k LIMIT 1),
val AS (SELECT {BAND} AS b, count(*) AS n FROM shipments WHERE {BAND} IS NOT NULL GROUP BY 1),
fast AS (SELECT carrier AS k, {eavg(T)} AS m FROM shipments GROUP BY 1 ORDER BY m, k LIMIT 1),
tq AS (SELECT {q(T, 0.25)} AS q1, {q(T, 0.75)} AS q3, count(*) AS n FROM shipments),
tf AS (SELECT q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi, n FROM tq),
toc AS (SELECT CAST(sum(CASE WHEN s.{T} < tf.lo OR s.{T} > tf.hi THEN 1 ELSE 0 END) AS BIGINT) AS oc, max(tf.n) AS n
        FROM shipments s CROSS JOIN tf)
SELECT 'temporal' AS section, 'top_shipping_day' AS metric, k AS key, CAST(n AS DOUBLE) AS value FROM days
UNION ALL SELECT 'geographic', 'most_common_distance', CAST(k AS VARCHAR), CAST(n AS DOUBLE) FROM dist
UNION ALL SELECT 'package', b || '_count', NULL, CAST(n AS DOUBLE) FROM val
UNION ALL SELECT 'performance', 'fastest_carrier', k, {r('m')} FROM fast
UNION ALL SELECT 'segmentation', 'segments', NULL, CAST(count(DISTINCT segment) AS DOUBLE) FROM seg
UNION ALL SELECT 'segmentation', 'zone_pairs', CAST(segment AS VARCHAR), CAST(count(*) AS DOUBLE) FROM seg GROUP BY segment
UNION ALL SELECT 'anomalies', 'transit_outliers', NULL, CAST(oc AS DOUBLE) FROM toc
UNION ALL SELECT 'anomalies', 'transit_outlier_pct', NULL, {r('oc / n * 1e2')} FROM toc
UNION ALL SELECT 'insights', 'trend_slope', CASE WHEN slope < 0 THEN 'Improving' ELSE 'Declining' END, {r('slope')} FROM tr
UNION ALL SELECT 'insights', 'degradation_risk', CASE WHEN slope > 1e-1 THEN 'High' ELSE 'Low' END, {r('slope')} FROM tr"""


# ------------------------------------------------------------ data quality
from shiplens.functions import refdata as _rd  # noqa: E402


def dlit(v) -> str:
    """A DOUBLE literal in both engines."""
    return f"{float(v)!r}e0"


def _reasons_sql() -> str:
    parts = [f"CASE WHEN {f} IS NULL THEN 'missing:{f}' END" for f in _rd.REQUEST_REQUIRED]
    for f, (lo, hi) in _rd.REQUEST_RANGES.items():
        lo_s, hi_s = (str(lo), str(hi)) if f == "zone" else (dlit(lo), dlit(hi))
        parts.append(f"CASE WHEN {f} < {lo_s} OR {f} > {hi_s} THEN 'range:{f}' END")
    cl = ", ".join(f"'{c}'" for c in _rd.REQUEST_CARRIERS)
    sl = ", ".join(f"'{c}'" for c in _rd.REQUEST_SERVICES)
    parts.append(f"CASE WHEN NOT carrier IN ({cl}) THEN 'enum:carrier' END")
    parts.append(f"CASE WHEN NOT service_level IN ({sl}) THEN 'enum:service_level' END")
    return "concat_ws(';', " + ", ".join(parts) + ")"


@oracle("request_validation")
def _a6():
    return f"""SELECT request_id, l_linenumber, reasons = '' AS valid, reasons
FROM (SELECT request_id, l_linenumber, {_reasons_sql()} AS reasons FROM requests) v"""


@oracle("batch_summary")
def _m10_summary():
    return f"""SELECT CAST(count(*) AS BIGINT) AS count, CAST(sum(CASE WHEN reasons = '' THEN 1 ELSE 0 END) AS BIGINT) AS successful_count
FROM (SELECT {_reasons_sql()} AS reasons FROM requests) v"""


@oracle("batch_outcomes")
def _m10_outcomes():
    return f"""SELECT request_id, l_linenumber, reasons = '' AS success, reasons, reasons = '' AS has_transit, reasons = '' AS has_cost
FROM (SELECT request_id, l_linenumber, {_reasons_sql()} AS reasons FROM requests) v"""


@oracle("rejected_requests")
def _a6_rejected():
    return f"""SELECT request_id, l_linenumber, reasons
FROM (SELECT request_id, l_linenumber, {_reasons_sql()} AS reasons FROM requests) v WHERE reasons <> ''"""


@oracle("drop_missing_targets")
def _a7():
    return """SELECT l_orderkey, l_linenumber, ship_date, carrier, service_level, dest_zone, transit_time_raw, shipping_cost_raw
FROM shipments_raw WHERE transit_time_raw IS NOT NULL AND shipping_cost_raw IS NOT NULL AND ship_date IS NOT NULL"""


@oracle("dataset_profile")
def _a8():
    return """SELECT CAST(count(*) AS BIGINT) AS total_rows, min(ship_date) AS min_date, max(ship_date) AS max_date,
 CAST(count(DISTINCT carrier) AS BIGINT) AS carriers, CAST(count(DISTINCT service_level) AS BIGINT) AS service_levels,
 CAST(count(DISTINCT origin_zone) AS BIGINT) AS origin_zones, CAST(count(DISTINCT dest_zone) AS BIGINT) AS dest_zones,
 CAST(sum(CASE WHEN transit_time_raw IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_transit_time,
 CAST(sum(CASE WHEN shipping_cost_raw IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_shipping_cost
FROM shipments_raw"""


@oracle("describe_targets")
def _a9():
    cols = ["transit_time_raw", "shipping_cost_raw", "package_weight_lbs", "package_volume_cubic_in", "insurance_value"]
    u = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM shipments_raw" for c in cols)
    return f"""SELECT column_name AS "column", CAST(count(v) AS BIGINT) AS count, {r(eavg('v'))} AS mean,
 {r('stddev_samp(v)')} AS std, {r('min(v)')} AS min, {r(q('v', 0.25))} AS p25, {r(q('v', 0.5))} AS p50,
 {r(q('v', 0.75))} AS p75, {r('max(v)')} AS max FROM ({u}) u GROUP BY column_name"""


@oracle("service_value_counts")
def _a10a():
    return "SELECT service_level, CAST(count(*) AS BIGINT) AS n FROM shipments GROUP BY service_level"


@oracle("zone_value_counts")
def _a10b():
    return "SELECT dest_zone AS zone, CAST(count(*) AS BIGINT) AS n FROM shipments GROUP BY dest_zone ORDER BY zone"


@oracle("training_profile")
def _a11():
    lst = lambda c: f"array_to_string(list_sort(list_distinct(list({c}))), ',')"
    return f"""SELECT CAST(count(*) AS BIGINT) AS total_shipments, {lst('carrier')} AS carriers,
 {lst('service_level')} AS service_levels, {lst('dest_zone')} AS zones_covered, min(ship_date) AS min_date,
 max(ship_date) AS max_date, CAST(15 AS BIGINT) AS features_count FROM shipments"""


# ------------------------------------------------------------- row rules
@oracle("calendar_features")
def _p1():
    return """SELECT l_orderkey, l_linenumber, ship_date, CAST(isodow(ship_date) - 1 AS INT) AS dow,
 CAST(month(ship_date) AS INT) AS month, CAST(dayofyear(ship_date) AS INT) AS day_of_year,
 CAST(quarter(ship_date) AS INT) AS quarter, dayname(ship_date) AS day_of_week FROM shipments"""


@oracle("cyclical_features")
def _p2():
    d = "CAST(isodow(ship_date) - 1 AS INT)"
    m = "CAST(month(ship_date) AS INT)"
    return f"""SELECT l_orderkey, l_linenumber, ship_date,
 {r(f'sin(2e0 * pi() * {d} / 7e0)')} AS dow_sin, {r(f'cos(2e0 * pi() * {d} / 7e0)')} AS dow_cos,
 {r(f'sin(2e0 * pi() * {m} / 1.2e1)')} AS month_sin, {r(f'cos(2e0 * pi() * {m} / 1.2e1)')} AS month_cos FROM shipments"""


@oracle("route_keys")
def _p3():
    return """SELECT l_orderkey, l_linenumber, CAST(origin_zone AS VARCHAR) || '->' || CAST(dest_zone AS VARCHAR) AS route,
 CAST(origin_zone AS VARCHAR) || '::' || service_level AS origin_service, carrier || '::' || service_level AS carrier_service
FROM shipments"""


PKG = """(package_length_in * package_width_in * package_height_in)"""


@oracle("package_features")
def _p4():
    dim = f"({PKG} / 1.66e2)"
    return f"""SELECT l_orderkey, l_linenumber, {r(PKG)} AS package_volume, {r(dim)} AS dimensional_weight,
 {r(f'CASE WHEN package_weight_lbs IS NULL OR {dim} IS NULL THEN NULL ELSE greatest(package_weight_lbs, {dim}) END')} AS billable_weight,
 {r(f'package_weight_lbs / ({PKG} + 1e0)')} AS weight_to_volume_ratio FROM shipments"""


def _intervals_sql(chart: str) -> str:
    rows = ", ".join(f"({i}, {lo}, {hi}, {z})" for i, (lo, hi, z) in enumerate(_rd.zip_chart(chart)))
    return f"iv(ord, lo, hi, zone) AS (VALUES {rows})"


def zip_zone_sql(chart: str = "utils") -> str:
    def zone(p):
        return (f"CASE WHEN {p} IS NULL THEN NULL ELSE CAST(coalesce((SELECT arg_min(iv.zone, iv.ord) FROM iv "
                f"WHERE {p} BETWEEN iv.lo AND iv.hi), {_rd.DEFAULT_ZIP_ZONE}) AS INT) END")
    return f"""WITH {_intervals_sql(chart)},
lp AS (SELECT o_orderkey, origin_zip, dest_zip, TRY_CAST(substr(origin_zip, 1, 3) AS INTEGER) AS op,
              TRY_CAST(substr(dest_zip, 1, 3) AS INTEGER) AS dp FROM lanes),
zz AS (SELECT o_orderkey, origin_zip, {zone('op')} AS origin_zone, dest_zip, {zone('dp')} AS dest_zone,
 concat_ws(';', CASE WHEN op IS NULL THEN 'bad:origin_zip' END, CASE WHEN dp IS NULL THEN 'bad:dest_zip' END) AS reasons
 FROM lp)"""


@oracle("zip_zone_lookup")
def _p7():
    return zip_zone_sql() + "\nSELECT * FROM zz"


@oracle("zip_lane_zone")
def _p8():
    return zip_zone_sql() + """
SELECT o_orderkey, origin_zone, dest_zone, abs(origin_zone - dest_zone) AS zone_distance,
 least(9, greatest(1, abs(origin_zone - dest_zone) + 1)) AS rate_zone FROM zz"""


def _rate_cte() -> str:
    rc = ", ".join(f"('{s}', {z + 1}, {dlit(_rd.BASE_TRANSIT_DAYS[s][z])}, {dlit(_rd.BASE_COST_USD[s][z])})"
                   for s in _rd.RATE_SERVICES for z in range(9))
    ce = ", ".join(f"('{c}', {dlit(_rd.CARRIER_DAYS_OFFSET[c])}, {dlit(_rd.CARRIER_COST_MULT[c])})"
                   for c in _rd.CARRIER_DAYS_OFFSET)
    return f"""rc(svc, rz, base_days, base_cost) AS (VALUES {rc}),
ce(car, days_offset, cost_mult) AS (VALUES {ce}),
rq AS (SELECT q.request_id, q.l_linenumber, q.ship_date, q.carrier, q.service_level, q.zone AS rate_zone,
  q.package_weight_lbs, q.package_length_in, q.package_width_in, q.package_height_in, rc.base_days, rc.base_cost,
  coalesce(ce.days_offset, 0e0) AS days_offset, coalesce(ce.cost_mult, 1e0) AS cost_mult
  FROM requests q LEFT JOIN rc ON q.service_level = rc.svc AND q.zone = rc.rz LEFT JOIN ce ON q.carrier = ce.car)"""


@oracle("rate_card_lookup")
def _p10():
    return f"WITH {_rate_cte()}\nSELECT request_id, l_linenumber, service_level, rate_zone, base_days, base_cost FROM rq"


@oracle("expected_transit")
def _p11():
    t = "(base_days + days_offset)"
    return f"""WITH {_rate_cte()}
SELECT request_id, l_linenumber, carrier, service_level, rate_zone,
 {r(f'CASE WHEN {t} IS NULL THEN NULL ELSE round(greatest(1.0e0, least({t}, 30.0e0)) * 1e1) / 1e1 END')} AS expected_transit_days
FROM rq"""


@oracle("expected_cost")
def _p12():
    vol = PKG
    dim = f"({vol} / 1.66e2)"
    bill = f"(CASE WHEN package_weight_lbs IS NULL OR {dim} IS NULL THEN NULL ELSE greatest(package_weight_lbs, {dim}) END)"
    c = f"(base_cost * cost_mult * (1e0 + ({bill} - 1e0) * 0.08e0) * (1e0 + (month(ship_date) % 12) * 0.005e0))"
    return f"""WITH {_rate_cte()}
SELECT request_id, l_linenumber, carrier, service_level, rate_zone,
 {r(f'CASE WHEN {c} IS NULL THEN NULL ELSE greatest(3.0e0, round({c} * 1e2) / 1e2) END')} AS expected_cost_usd FROM rq"""


@oracle("distance_category_counts")
def _p13():
    return """WITH code AS (SELECT n.n_nationkey, r.r_name || '_' || n.n_name AS code FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
j AS (SELECT split_part(sc.code, '_', 1) AS o, split_part(cc.code, '_', 1) AS d
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN code cc ON c.c_nationkey = cc.n_nationkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN code sc ON s.s_nationkey = sc.n_nationkey)
SELECT CASE WHEN o = d THEN 'domestic' WHEN (o IN ('US', 'CANADA') AND d IN ('US', 'CANADA')) OR (o = 'EU' AND d = 'EU')
  THEN 'regional' ELSE 'international' END AS distance_category, CAST(count(*) AS BIGINT) AS n FROM j GROUP BY 1"""


@oracle("zone_labels")
def _p9():
    return """SELECT TRY_CAST(regexp_extract('Zone_' || CAST(origin_zone AS VARCHAR), '_(\\d+)$', 1) AS INTEGER) AS zone,
 CAST(count(*) AS BIGINT) AS n FROM shipments GROUP BY 1"""


def _linear_sql() -> str:
    sp = ", ".join(f"('{s}', {dlit(a)}, {dlit(b)}, {dlit(c)})" for s, (a, b, c) in _rd.SERVICE_SPECS.items())
    ca = ", ".join(f"('{c}', {dlit(a)}, {dlit(b)})" for c, (a, b) in _rd.CARRIER_ADJUSTMENTS.items())
    days = "greatest(0.8e0, (base_time + (dest_zone - 1) * zone_factor) * greatest(0.7e0, least(1.4e0, time_mult)))"
    cost = ("greatest(2.5e0, (base_cost + (dest_zone - 1) * zone_factor * 5e-1 + package_weight_lbs * 0.3e0"
            " + package_volume_cubic_in * 0.0005e0) * CASE WHEN package_weight_lbs > 1.0e1 THEN 1.2e0"
            " WHEN package_weight_lbs < 1.0e0 THEN 0.9e0 ELSE 1e0 END * greatest(0.75e0, least(1.35e0, cm)))")
    return f"""sp(svc, base_time, zone_factor, base_cost) AS (VALUES {sp}),
ca(car, time_mult, cm) AS (VALUES {ca}),
lm AS (SELECT s.l_orderkey, s.l_linenumber, s.carrier, s.service_level, s.{T}, s.{C}, {days} AS model_days, {cost} AS model_cost
       FROM shipments s LEFT JOIN sp ON s.service_level = sp.svc LEFT JOIN ca ON s.carrier = ca.car)"""


@oracle("linear_rate_model")
def _p14():
    return f"WITH {_linear_sql()}\nSELECT l_orderkey, l_linenumber, {r('model_days')} AS model_days, {r('model_cost')} AS model_cost FROM lm"


@oracle("rate_residuals")
def _p15():
    return f"""WITH {_linear_sql()}
SELECT carrier, service_level, CAST(count(*) AS BIGINT) AS n, {r(f'avg({T} - model_days)')} AS mean_days_residual,
 {r(f'avg(abs({T} - model_days))')} AS mae_days, {r(f'avg({C} - model_cost)')} AS mean_cost_residual,
 {r(f'avg(abs({C} - model_cost))')} AS mae_cost FROM lm GROUP BY carrier, service_level"""


@oracle("default_ship_date")
def _p19():
    return """SELECT request_id, l_linenumber, coalesce(ship_date, DATE '2024-06-30') AS ship_date,
 ship_date IS NULL AS date_defaulted FROM requests"""


# --------------------------------------------------------- feature pipeline
ORDER_COLS = ("ship_date, l_orderkey, l_linenumber, origin_zone, dest_zone, carrier, service_level, "
              "package_weight_lbs, package_length_in, package_width_in, package_height_in, "
              f"package_volume_cubic_in, insurance_value, {T}, {C}")
SPLIT = f"""sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {ORDER_COLS}) <= floor(count(*) OVER () * 8e-1)
                 THEN 'train' ELSE 'valid' END AS split FROM shipments)"""
KEYS = """ks AS (SELECT *, CAST(origin_zone AS VARCHAR) || '->' || CAST(dest_zone AS VARCHAR) AS route,
       CAST(origin_zone AS VARCHAR) || '::' || service_level AS origin_service, carrier || '::' || service_level AS carrier_service
       FROM sp)"""
ENC_COLS = ["route", "origin_zone", "dest_zone", "carrier", "service_level", "origin_service", "carrier_service"]


@oracle("time_split")
def _m1():
    return f"""WITH {SPLIT}
SELECT split, CAST(count(*) AS BIGINT) AS n, min(ship_date) AS min_date, max(ship_date) AS max_date FROM sp GROUP BY split"""


def enc_sql(src: str, k: float, s: float) -> str:
    u = " UNION ALL ".join(f"SELECT '{c}' AS enc_col, CAST({c} AS VARCHAR) AS category, {T}, {C} FROM {src}"
                           for c in ENC_COLS)
    parts = []
    for t, col in (("time", T), ("cost", C)):
        lam = f"(1e0 / (1e0 + exp(-(n_{t} - {dlit(k)}) / {dlit(s)})))"
        parts.append(f"""SELECT enc_col, category, '{t}' AS target, n_{t} AS n, mean_{t} AS mean, {lam} AS smoothing,
  prior_{t} * (1e0 - {lam}) + mean_{t} * {lam} AS enc, prior_{t} AS prior FROM g""")
    return f"""u AS ({u}),
pr AS (SELECT {eavg(T)} AS prior_time, {eavg(C)} AS prior_cost FROM {src}),
g AS (SELECT enc_col, category, CAST(count({T}) AS BIGINT) AS n_time, {eavg(T)} AS mean_time,
             CAST(count({C}) AS BIGINT) AS n_cost, {eavg(C)} AS mean_cost, max(pr.prior_time) AS prior_time,
             max(pr.prior_cost) AS prior_cost FROM u CROSS JOIN pr GROUP BY enc_col, category),
enc AS ({' UNION ALL '.join(parts)})"""


ENC_OUT = f"""SELECT enc_col, category, target, n, {r('mean')} AS mean, {r('smoothing')} AS smoothing, {r('enc')} AS enc,
 {r('prior')} AS prior FROM enc"""


@oracle("target_encoding")
def _m2():
    return f"""WITH {SPLIT}, {KEYS}, tr AS (SELECT * FROM ks WHERE split = 'train'),
{enc_sql('tr', 200, 20)}
{ENC_OUT}"""


@oracle("serving_encodings")
def _m5():
    return f"""WITH sp AS (SELECT * FROM shipments), {KEYS},
{enc_sql('ks', 100, 10)}
{ENC_OUT}"""


def apply_enc_sql(src: str, cat_exprs: dict) -> tuple[str, str]:
    """LEFT JOINs of the encoding table per column; returns (joins, select list)."""
    joins, sel = [], []
    for i, c in enumerate(ENC_COLS):
        joins.append(f"LEFT JOIN (SELECT category, max(CASE WHEN target = 'time' THEN enc END) AS et, "
                     f"max(CASE WHEN target = 'cost' THEN enc END) AS ec FROM enc WHERE enc_col = '{c}' GROUP BY category) e{i} "
                     f"ON CAST({cat_exprs.get(c, src + '.' + c)} AS VARCHAR) = e{i}.category")
        sel.append(f"coalesce(e{i}.et, pri.pt) AS {c}_te_time")
        sel.append(f"coalesce(e{i}.ec, pri.pc) AS {c}_te_cost")
    joins.append("CROSS JOIN (SELECT max(CASE WHEN target = 'time' THEN prior END) AS pt, "
                 "max(CASE WHEN target = 'cost' THEN prior END) AS pc FROM enc) pri")
    return "\n".join(joins), ", ".join(sel)


@oracle("target_encoded_rows")
def _m2rows():
    joins, sel = apply_enc_sql("ks", {})
    encs = [f"{c}_te_{t}" for c in ENC_COLS for t in ("time", "cost")]
    return f"""WITH {SPLIT}, {KEYS}, tr AS (SELECT * FROM ks WHERE split = 'train'),
{enc_sql('tr', 200, 20)},
x AS (SELECT ks.l_orderkey, ks.l_linenumber, ks.ship_date, ks.carrier, ks.service_level, ks.origin_zone, ks.dest_zone, {sel}
      FROM ks {joins})
SELECT l_orderkey, l_linenumber, ship_date, carrier, service_level, origin_zone, dest_zone,
 {', '.join(f"{r(e)} AS {e}" for e in encs)} FROM x"""


MED_WINDOW = "PARTITION BY route ORDER BY ship_date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING"
GLOBAL_MED = f"gm AS (SELECT {q(T, 0.5)} AS gt, {q(C, 0.5)} AS gc FROM shipments)"


@oracle("route_30d_median")
def _m3():
    return f"""WITH sp AS (SELECT * FROM shipments), {KEYS}, {GLOBAL_MED}
SELECT l_orderkey, l_linenumber, route, ship_date,
 {r(f'coalesce({q(T, 0.5)} OVER w, gm.gt)')} AS route_30d_median_time,
 {r(f'coalesce({q(C, 0.5)} OVER w, gm.gc)')} AS route_30d_median_cost
FROM ks CROSS JOIN gm WINDOW w AS ({MED_WINDOW})"""


@oracle("request_history_features")
def _m4():
    return f"""WITH {GLOBAL_MED},
u AS (SELECT CAST(origin_zone AS VARCHAR) || '->' || CAST(dest_zone AS VARCHAR) AS route, ship_date, {T} AS ht, {C} AS hc,
             CAST(NULL AS BIGINT) AS request_id, CAST(NULL AS INT) AS l_linenumber, FALSE AS is_req, '' AS reason FROM shipments
      UNION ALL
      SELECT CAST(zone AS VARCHAR) || '->' || CAST(zone AS VARCHAR), coalesce(ship_date, DATE '2024-06-30'), NULL, NULL,
        request_id, l_linenumber, TRUE, concat_ws(';', CASE WHEN ship_date IS NULL THEN 'missing:ship_date' END,
          CASE WHEN zone IS NULL OR zone NOT BETWEEN 1 AND 9 THEN 'range:zone' END)
      FROM requests),
m AS (SELECT request_id, l_linenumber, route, ship_date, is_req, reason, {q('ht', 0.5)} OVER w AS mt, {q('hc', 0.5)} OVER w AS mc
      FROM u WINDOW w AS ({MED_WINDOW}))
SELECT request_id, l_linenumber, route, ship_date, reason, {r('coalesce(mt, gm.gt)')} AS route_30d_median_time,
 {r('coalesce(mc, gm.gc)')} AS route_30d_median_cost FROM m CROSS JOIN gm WHERE is_req"""


# fixed values: the model's features, in order (stated here by themselves: the oracle checks the operators)
TIME_F = ["dow_sin", "dow_cos", "month_sin", "month_cos", "package_weight_lbs", "package_volume",
          "dimensional_weight", "billable_weight", "weight_to_volume_ratio", "route_30d_median_time",
          "route_te_time", "origin_zone_te_time", "dest_zone_te_time", "carrier_te_time",
          "service_level_te_time", "origin_service_te_time", "carrier_service_te_time"]
COST_F = [f.replace("_time", "_cost") for f in TIME_F]
FEATURES = {"time": TIME_F, "cost": COST_F, "zones": TIME_F[:4] + TIME_F[9:]}


def _row_feats(src: str) -> str:
    d = f"CAST(isodow({src}.ship_date) - 1 AS INT)"
    m = f"CAST(month({src}.ship_date) AS INT)"
    vol = f"({src}.package_length_in * {src}.package_width_in * {src}.package_height_in)"
    dim = f"({vol} / 1.66e2)"
    w = f"{src}.package_weight_lbs"
    return (f"sin(2e0 * pi() * {d} / 7e0) AS dow_sin, cos(2e0 * pi() * {d} / 7e0) AS dow_cos, "
            f"sin(2e0 * pi() * {m} / 1.2e1) AS month_sin, cos(2e0 * pi() * {m} / 1.2e1) AS month_cos, "
            f"{vol} AS package_volume, {dim} AS dimensional_weight, "
            f"CASE WHEN {w} IS NULL OR {dim} IS NULL THEN NULL ELSE greatest({w}, {dim}) END AS billable_weight, "
            f"{w} / ({vol} + 1e0) AS weight_to_volume_ratio")


def feature_matrix_sql(target: str) -> str:
    feats = FEATURES[target]
    joins, sel = apply_enc_sql("ks", {})
    label = C if target == "cost" else T
    return f"""WITH {SPLIT}, {KEYS}, {GLOBAL_MED}, tr AS (SELECT * FROM ks WHERE split = 'train'),
{enc_sql('tr', 200, 20)},
md AS (SELECT l_orderkey, l_linenumber, ship_date, route, {', '.join(c for c in ORDER_COLS.split(', ') if c not in ('l_orderkey', 'l_linenumber', 'ship_date'))},
        coalesce({q(T, 0.5)} OVER w, gm.gt) AS route_30d_median_time, coalesce({q(C, 0.5)} OVER w, gm.gc) AS route_30d_median_cost
       FROM ks CROSS JOIN gm WINDOW w AS ({MED_WINDOW})),
x AS (SELECT ks.l_orderkey, ks.l_linenumber, ks.split, ks.package_weight_lbs, ks.{label} AS label, md.route_30d_median_time,
        md.route_30d_median_cost, {_row_feats('ks')}, {sel}
      FROM ks JOIN md ON {' AND '.join(f'ks.{c} IS NOT DISTINCT FROM md.{c}' for c in ORDER_COLS.split(', '))} {joins})
SELECT l_orderkey, l_linenumber, split, {', '.join(f'{r(c)} AS {c}' for c in feats)}, label FROM x"""


@oracle("feature_matrix_time")
def _m6t():
    return feature_matrix_sql("time")


@oracle("feature_matrix_cost")
def _m6c():
    return feature_matrix_sql("cost")


@oracle("feature_matrix_zones")
def _m6z():
    return feature_matrix_sql("zones")


@oracle("serving_features_zone_only")
def _m13():
    cats = {"route": "CAST(rq.zone AS VARCHAR) || '->' || CAST(rq.zone AS VARCHAR)", "origin_zone": "rq.zone",
            "dest_zone": "rq.zone", "origin_service": "CAST(rq.zone AS VARCHAR) || '::' || rq.service_level",
            "carrier_service": "rq.carrier || '::' || rq.service_level", "carrier": "rq.carrier",
            "service_level": "rq.service_level"}
    joins, sel = apply_enc_sql("rq", cats)
    cols = sorted(set(TIME_F + COST_F))
    return f"""WITH {SPLIT}, {KEYS}, tr AS (SELECT * FROM ks WHERE split = 'train'),
{enc_sql('tr', 200, 20)},
x AS (SELECT rq.request_id, rq.l_linenumber, rq.package_weight_lbs, {_row_feats('rq')},
        {dlit(_rd.ZONE_ONLY_MEDIAN_TIME)} AS route_30d_median_time, {dlit(_rd.ZONE_ONLY_MEDIAN_COST)} AS route_30d_median_cost,
        {sel} FROM requests rq {joins})
SELECT request_id, l_linenumber, {', '.join(f'{r(c)} AS {c}' for c in cols)} FROM x"""


@oracle("carrier_quotes")
def _m14():
    cars = ", ".join(f"('{c}', {dlit(_rd.CARRIER_DAYS_OFFSET.get(c, 0.0))}, {dlit(_rd.CARRIER_COST_MULT.get(c, 1.0))})"
                     for c in _rd.QUOTE_CARRIERS)
    rc = ", ".join(f"('{s}', {z + 1}, {dlit(_rd.BASE_TRANSIT_DAYS[s][z])}, {dlit(_rd.BASE_COST_USD[s][z])})"
                   for s in _rd.RATE_SERVICES for z in range(9))
    vol = "(package_length_in * package_width_in * package_height_in)"
    dim = f"({vol} / 1.66e2)"
    bill = f"(CASE WHEN package_weight_lbs IS NULL OR {dim} IS NULL THEN NULL ELSE greatest(package_weight_lbs, {dim}) END)"
    t = "(base_days + off)"
    c = f"(base_cost * mult * (1e0 + ({bill} - 1e0) * 0.08e0) * (1e0 + (month(ship_date) % 12) * 0.005e0))"
    days = f"CASE WHEN {t} IS NULL THEN NULL ELSE round(greatest(1.0e0, least({t}, 30.0e0)) * 1e1) / 1e1 END"
    cost = f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest(3.0e0, round({c} * 1e2) / 1e2) END"
    return f"""WITH cq(carrier, off, mult) AS (VALUES {cars}),
rc(svc, rz, base_days, base_cost) AS (VALUES {rc}),
rq AS (SELECT *, row_number() OVER () AS rid FROM requests),
x AS (SELECT rq.rid, rq.request_id, rq.l_linenumber, cq.carrier, {days} AS d, {cost} AS c
      FROM rq CROSS JOIN cq LEFT JOIN rc ON rq.service_level = rc.svc AND rq.zone = rc.rz),
k AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY c NULLS LAST, carrier) AS rk FROM x)
SELECT request_id, l_linenumber, carrier, {r('d')} AS expected_transit_days, {r('c')} AS expected_cost_usd,
 CAST(rk AS INT) AS rank, rk = 1 AS is_best FROM k"""


# --------------------------------------------------------- streaming twins
@oracle("daily_prediction_counts")
def _s1():
    return """WITH d AS (SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM prediction_events WHERE success GROUP BY 1)
SELECT day, n FROM d WHERE day >= (SELECT max(day) FROM d) - INTERVAL 30 DAYS"""


@oracle("prediction_stats")
def _s1b():
    return """WITH d AS (SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM prediction_events WHERE success GROUP BY 1),
k AS (SELECT * FROM d WHERE day >= (SELECT max(day) FROM d) - INTERVAL 30 DAYS)
SELECT max(day) AS date, arg_max(n, day) AS today,
 (SELECT CAST(count(*) AS BIGINT) FROM prediction_events WHERE success) AS total,
 CAST(floor(avg(n) + 5e-1) AS BIGINT) AS average_daily, CAST(count(*) AS BIGINT) AS active_days FROM k"""


@oracle("response_time_stats")
def _s2():
    return """WITH t AS (SELECT response_ms FROM prediction_events ORDER BY ts DESC, request_id DESC LIMIT 1000),
r AS (SELECT response_ms, row_number() OVER (ORDER BY response_ms) AS rk, count(*) OVER () AS n FROM t)
SELECT CAST(floor((CAST(sum(CAST(response_ms AS DECIMAL(38,7))) AS DOUBLE) / count(response_ms)) + 5e-1) AS BIGINT) AS average_ms,
 CAST(floor(max(CASE WHEN rk = floor(n / 2) + 1 THEN response_ms END) + 5e-1) AS BIGINT) AS median_ms,
 CAST(floor(min(response_ms) + 5e-1) AS BIGINT) AS min_ms, CAST(floor(max(response_ms) + 5e-1) AS BIGINT) AS max_ms,
 (SELECT CAST(count(*) AS BIGINT) FROM prediction_events) AS total_requests, CAST(count(*) AS BIGINT) AS recent_samples
FROM r"""


@oracle("stream_service_summary")
def _s4():
    return f"""SELECT service_level, CAST(count(*) AS BIGINT) AS n, {r(eavg(T))} AS avg_transit_time,
 {r(f'stddev_samp({T})')} AS transit_time_std, {r(eavg(C))} AS avg_cost, {r(f'stddev_samp({C})')} AS cost_std
FROM shipments GROUP BY service_level"""


@oracle("stream_score")
def _s3():
    vol = "(package_length_in * package_width_in * package_height_in)"
    dim = f"({vol} / 1.66e2)"
    bill = f"(CASE WHEN package_weight_lbs IS NULL OR {dim} IS NULL THEN NULL ELSE greatest(package_weight_lbs, {dim}) END)"
    t = "(base_days + days_offset)"
    c = f"(base_cost * cost_mult * (1e0 + ({bill} - 1e0) * 0.08e0) * (1e0 + (month(ship_date) % 12) * 0.005e0))"
    return f"""WITH {_rate_cte()},
v AS (SELECT q.request_id, q.l_linenumber, q.ship_date, q.package_weight_lbs, q.package_length_in, q.package_width_in,
        q.package_height_in, rc.base_days, rc.base_cost, coalesce(ce.days_offset, 0e0) AS days_offset,
        coalesce(ce.cost_mult, 1e0) AS cost_mult, {_reasons_sql()} AS reasons
      FROM requests q LEFT JOIN rc ON q.service_level = rc.svc AND q.zone = rc.rz LEFT JOIN ce ON q.carrier = ce.car)
SELECT request_id, l_linenumber, reasons = '' AS success, reasons,
 CASE WHEN reasons = '' THEN {r(f'CASE WHEN {t} IS NULL THEN NULL ELSE round(greatest(1.0e0, least({t}, 30.0e0)) * 1e1) / 1e1 END')} END AS predicted_transit_days,
 CASE WHEN reasons = '' THEN {r(f'CASE WHEN {c} IS NULL THEN NULL ELSE greatest(3.0e0, round({c} * 1e2) / 1e2) END')} END AS predicted_cost_usd
FROM v"""


@oracle("baseline_eval")
def _m9b():
    md = f"""md AS (SELECT split, {T}, {C}, coalesce({q(T, 0.5)} OVER w, gm.gt) AS mt, coalesce({q(C, 0.5)} OVER w, gm.gc) AS mc
       FROM ks CROSS JOIN gm WINDOW w AS ({MED_WINDOW}))"""
    return f"""WITH {SPLIT}, {KEYS}, {GLOBAL_MED}, {md}
SELECT 'time' AS target, CAST(count(*) AS BIGINT) AS n, {r(f'avg(abs({T} - mt))')} AS mae,
 {r(f'sqrt(avg(({T} - mt) * ({T} - mt)))')} AS rmse FROM md WHERE split = 'valid'
UNION ALL
SELECT 'cost', CAST(count(*) AS BIGINT), {r(f'avg(abs({C} - mc))')}, {r(f'sqrt(avg(({C} - mc) * ({C} - mc)))')}
FROM md WHERE split = 'valid'"""
