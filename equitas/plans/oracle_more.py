"""DuckDB statements for the scenario and split queries (see :mod:`.oracle`)."""

from __future__ import annotations

from .catalog import LINEITEM_MODEL, ORDER_MODEL
from .oracle_eval import score_sql

_A, _COEFS = LINEITEM_MODEL
_FEATS = list(_COEFS)


def _stats_cte() -> str:
    parts = [f"SELECT '{f}' AS feature, {i} AS idx, min(CAST({f} AS DOUBLE)) AS mn, max(CAST({f} AS DOUBLE)) AS mx, "
             f"coalesce(quantile_cont(CAST({f} AS DOUBLE), 0.5), avg(CAST({f} AS DOUBLE)), 0.0) AS base "
             f"FROM lineitem" for i, f in enumerate(_FEATS)]
    return "st AS (" + " UNION ALL ".join(parts) + ")"


def _grid_sql() -> str:
    cols = ", ".join(
        f"CASE WHEN g.feature = '{f}' THEN g.value ELSE (SELECT base FROM st WHERE feature = '{f}') END AS {f}"
        for f in _FEATS)
    return (f"WITH {_stats_cte()}, g AS (SELECT feature, step, mn + step * (mx - mn) / 100 AS value "
            "FROM st, range(0, 101) r(step)), "
            f"w AS (SELECT g.feature, g.step, g.value, {cols} FROM g) "
            f"SELECT feature, CAST(step AS BIGINT) AS step, round(value, 6) AS value, "
            f"round({score_sql(LINEITEM_MODEL)}, 6) AS prob FROM w")


def _scenario_sql() -> str:
    a, coefs = ORDER_MODEL
    feats = list(coefs)
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in feats)
    phis = [f"({b!r} * (CAST({c} AS DOUBLE) - m_{c}))" for c, b in coefs.items()]
    items = ", ".join(f"{{'neg_mag': -abs({p}), 'neg_idx': {-i}, 'feature': '{c}', 'v': {p}}}"
                      for i, (c, p) in enumerate(zip(feats, phis)))
    prob = score_sql(ORDER_MODEL)
    return (
        "WITH li AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty, "
        "avg(l_discount) AS avg_disc FROM lineitem GROUP BY l_orderkey), "
        "f AS (SELECT o_orderkey, o_totalprice, coalesce(CAST(n_lines AS DOUBLE), 0.0) AS n_lines, "
        "coalesce(CAST(sum_qty AS DOUBLE), 0.0) AS sum_qty, coalesce(CAST(avg_disc AS DOUBLE), 0.0) AS avg_disc, "
        "0.0 AS avg_tax FROM orders LEFT JOIN li ON o_orderkey = l_orderkey), "
        f"m AS (SELECT {means} FROM f), "
        f"s AS (SELECT o_orderkey, {prob} AS prob, list_sort([{items}]) AS fl FROM f, m) "
        "SELECT o_orderkey, round(prob, 6) AS prob, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS prediction, "
        "CASE WHEN prob > 0.7 THEN 'High' WHEN prob >= 0.4 THEN 'Medium' ELSE 'Low' END AS intervention_tier, "
        "array_to_string(list_transform(list_slice(fl, 1, 5), lambda x: x.feature), '|') AS top_factors FROM s")


SQL: dict[str, str] = {
    "scenario_baseline": (f"WITH {_stats_cte()} SELECT feature, round(mn, 6) AS min, round(mx, 6) AS max, "
                          "round(base, 6) AS baseline FROM st"),
    "scenario_grid": _grid_sql(),
    "score_scenarios": _scenario_sql(),
    "split_md5": (
        "WITH h AS (SELECT o_orderkey, o_orderstatus, CAST(CAST('0x' || substr(md5('42|' || "
        "CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT) AS DOUBLE) AS h FROM orders), "
        "c AS (SELECT o_orderstatus, quantile_cont(h, 0.2) AS cut FROM h GROUP BY 1) "
        "SELECT h.o_orderkey, h.o_orderstatus, h.h <= c.cut AS is_test FROM h JOIN c "
        "ON h.o_orderstatus = c.o_orderstatus"),
}


_WINDOWS = (
    "WITH b AS (SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, 'event_type' AS attribute, "
    "event_type AS grp, CASE WHEN value >= 35 THEN 1 ELSE 0 END AS p, "
    "CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 THEN 1 ELSE 0 END AS y FROM events), "
    "g AS (SELECT window_start, attribute, grp, count(*) AS n, CAST(sum(p) AS DOUBLE) / count(*) AS rate, "
    "CASE WHEN sum(y) > 0 THEN CAST(sum(p * y) AS DOUBLE) / sum(y) ELSE 0.0 END AS tpr FROM b GROUP BY ALL), "
    "r AS (SELECT window_start, attribute, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows, "
    "CASE WHEN count(*) >= 2 THEN max(rate) - min(rate) ELSE 0.0 END AS dpd, "
    "CASE WHEN count(*) >= 2 THEN max(tpr) - min(tpr) ELSE 0.0 END AS eod FROM g GROUP BY ALL) "
    "SELECT window_start, attribute, n_groups, n_rows, round(dpd, 6) AS dpd, round(eod, 6) AS eod, "
    "dpd >= 0.05 AS dpd_flagged, eod >= 0.05 AS eod_flagged FROM r")
SQL["bias_by_window"] = _WINDOWS
# the stream holds back the last window: the watermark has not passed its end
SQL["stream_bias_monitor"] = _WINDOWS + " WHERE window_start < (SELECT max(window_start) FROM r)"

# quartile groups by the window before, on a grid of three significant digits
_VALUE_WINDOWS = (
    "WITH b AS (SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS w, value AS v, "
    "CASE WHEN value <> 0 THEN CAST(floor(log10(abs(value))) AS INTEGER) END AS e, "
    "CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS p, "
    "CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 THEN 1 ELSE 0 END AS y "
    "FROM events WHERE value IS NOT NULL AND isfinite(value)), "
    "c AS (SELECT w, CASE WHEN v = 0 THEN 0.0::DOUBLE "
    "WHEN e < 2 THEN floor(v * pow(10.0::DOUBLE, 2 - e)) / pow(10.0::DOUBLE, 2 - e) "
    "ELSE floor(v / pow(10.0::DOUBLE, e - 2)) * pow(10.0::DOUBLE, e - 2) END AS cell, p, y FROM b), "
    "q AS (SELECT w, [quantile_disc(cell, 0.25), quantile_disc(cell, 0.5), quantile_disc(cell, 0.75)] AS edges "
    "FROM c GROUP BY w), "
    "u AS (SELECT w, list_distinct(coalesce(lag(edges) OVER (ORDER BY w), edges)) AS edges FROM q), "
    "g AS (SELECT w, len(list_filter(edges, lambda x: x < cell)) AS bin, count(*) AS n, "
    "CAST(sum(p) AS DOUBLE) / count(*) AS rate, "
    "CASE WHEN sum(y) > 0 THEN CAST(sum(p * y) AS DOUBLE) / sum(y) ELSE 0.0 END AS tpr "
    "FROM c JOIN u USING (w) GROUP BY ALL), "
    "r AS (SELECT w AS window_start, 'value' AS attribute, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows, "
    "max(rate) - min(rate) AS dpd, max(tpr) - min(tpr) AS eod FROM g GROUP BY w) "
    "SELECT window_start, attribute, n_groups, n_rows, round(dpd, 6) AS dpd, round(eod, 6) AS eod, "
    "dpd >= 0.05 AS dpd_flagged, eod >= 0.05 AS eod_flagged FROM r")
SQL["bias_by_value_window"] = _VALUE_WINDOWS
SQL["stream_value_monitor"] = _VALUE_WINDOWS
