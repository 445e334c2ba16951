"""DuckDB statements that recompute each registered query independently.

They run on the same parquet tables (pre-registered views) and must return the
same column names and values as :mod:`.catalog`.
"""

from __future__ import annotations

from .catalog import (CUSTOMER_SCORE, DOCUMENT_SCORE, LINEITEM_MODEL, LINEITEM_SCORE,
                      ORDER_MODEL)

Q = "[0, 0.25, 0.5, 0.75, 1]"


def _score_sql(spec) -> str:
    a, coefs = spec
    z = " + ".join([repr(a)] + [f"{b!r} * CAST({c} AS DOUBLE)" for c, b in coefs.items()])
    return f"(1.0 / (1.0 + exp(-({z}))))"


def _pred_sql(spec) -> str:
    return f"(CASE WHEN {_score_sql(spec)} >= 0.5 THEN 1 ELSE 0 END)"


def _audit_ctes(base_sql: str, attrs, key: str | None = None, prelude=()) -> str:
    """CTEs base, long, g (group level) and r (attribute level).

    ``attrs`` = [(column, type, mode)], mode in plain_num | plain_str |
    numeric_bins | ordinal_bins.
    """
    ctes = list(prelude) + [f"base AS ({base_sql})"]
    parts = []
    keep = f", {key}" if key else ""
    for i, (col, _typ, mode) in enumerate(attrs):
        if mode == "plain_num":
            parts.append(f"SELECT '{col}' AS attribute, CAST({col} AS VARCHAR) AS grp, "
                         f"CAST({col} AS DOUBLE) AS grp_ord, pred, y{keep} FROM base")
        elif mode == "plain_str":
            parts.append(f"SELECT '{col}' AS attribute, CAST({col} AS VARCHAR) AS grp, "
                         f"CAST(NULL AS DOUBLE) AS grp_ord, pred, y{keep} FROM base")
        elif mode == "numeric_bins":
            ctes.append(f"e{i} AS (SELECT list_distinct(quantile_cont(CAST({col} AS DOUBLE), {Q})) "
                        f"AS e FROM base)")
            b = f"greatest(len(list_filter(e{i}.e, lambda x: x < CAST(base.{col} AS DOUBLE))) - 1, 0)"
            kk = f", base.{key}" if key else ""
            parts.append(f"SELECT '{col}' AS attribute, CAST({b} AS VARCHAR) AS grp, "
                         f"CAST({b} AS DOUBLE) AS grp_ord, base.pred, base.y{kk} FROM base, e{i}")
        elif mode == "ordinal_bins":
            ctes.append(f"c{i} AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM "
                        f"(SELECT DISTINCT {col} AS v FROM base WHERE {col} IS NOT NULL))")
            ctes.append(f"e{i} AS (SELECT list_distinct(quantile_cont(CAST(c{i}.code AS DOUBLE), {Q})) "
                        f"AS e FROM base JOIN c{i} ON base.{col} = c{i}.v)")
            b = f"greatest(len(list_filter(e{i}.e, lambda x: x < CAST(c{i}.code AS DOUBLE))) - 1, 0)"
            kk = f", base.{key}" if key else ""
            parts.append(f"SELECT '{col}' AS attribute, CAST({b} AS VARCHAR) AS grp, "
                         f"CAST({b} AS DOUBLE) AS grp_ord, base.pred, base.y{kk} "
                         f"FROM base JOIN c{i} ON base.{col} = c{i}.v, e{i}")
        else:
            raise ValueError(mode)
    types = " ".join(f"WHEN '{c}' THEN '{t}'" for c, t, _ in attrs)
    ctes.append("long AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append(
        "g AS (SELECT attribute, grp, grp_ord, count(*) AS n, "
        "CAST(sum(pred) AS BIGINT) AS n_pred_pos, "
        "CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos, "
        "CAST(sum(CASE WHEN y = 1 THEN pred ELSE 0 END) AS BIGINT) AS n_true_pos, "
        "CAST(sum(pred) AS DOUBLE) / count(*) AS positive_rate, "
        "CASE WHEN sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) > 0 THEN "
        "CAST(sum(CASE WHEN y = 1 THEN pred ELSE 0 END) AS DOUBLE) / "
        "sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) ELSE 0.0 END AS tpr "
        "FROM long GROUP BY attribute, grp, grp_ord)")
    two = "count(grp) >= 2"
    ctes.append(
        "r AS (SELECT attribute, "
        f"CASE attribute {types} END AS attribute_type, "
        "count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows, "
        f"CASE WHEN {two} THEN max(positive_rate) - min(positive_rate) ELSE 0.0 END AS dpd, "
        f"CASE WHEN {two} THEN max(tpr) - min(tpr) ELSE 0.0 END AS eod, "
        f"CASE WHEN {two} THEN first(grp ORDER BY positive_rate DESC, grp_ord, grp) END AS dpd_max_group, "
        f"CASE WHEN {two} THEN first(grp ORDER BY positive_rate ASC, grp_ord, grp) END AS dpd_min_group, "
        f"CASE WHEN {two} THEN first(grp ORDER BY tpr DESC, grp_ord, grp) END AS eod_max_group, "
        f"CASE WHEN {two} THEN first(grp ORDER BY tpr ASC, grp_ord, grp) END AS eod_min_group "
        "FROM g GROUP BY attribute)")
    return "WITH " + ",\n".join(ctes)


_REPORT_SELECT = (
    "SELECT attribute, attribute_type, n_groups, n_rows, round(dpd, 6) AS dpd, round(eod, 6) AS eod, "
    "dpd_max_group, dpd_min_group, eod_max_group, eod_min_group, "
    "dpd >= 0.05 AS dpd_flagged, eod >= 0.05 AS eod_flagged, (dpd >= 0.05 OR eod >= 0.05) AS any_breach "
    "FROM r")

LINEITEM_BASE = (
    f"SELECT l_returnflag, l_linestatus, l_quantity, {_pred_sql(LINEITEM_SCORE)} AS pred, "
    "CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS y FROM lineitem")
LINEITEM_ATTRS = [("l_returnflag", "status", "plain_str"), ("l_linestatus", "status", "plain_str"),
                  ("l_quantity", "quantity", "numeric_bins")]

DOCS_BASE = (
    f"SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic AS y, "
    f"{_pred_sql(DOCUMENT_SCORE)} AS pred FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
DOCS_ATTRS = [("lang", "language", "plain_str"), ("source", "origin", "ordinal_bins")]

CUSTOMER_BASE = (
    f"SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal, {_pred_sql(CUSTOMER_SCORE)} AS pred, "
    "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS y FROM customer")
CUSTOMER_ATTRS = [("c_mktsegment", "segment", "plain_str"), ("c_nationkey", "nationality", "numeric_bins"),
                  ("c_acctbal", "socioeconomic", "numeric_bins")]

SQL: dict[str, str] = {}

SQL["audit_lineitem"] = _audit_ctes(LINEITEM_BASE, LINEITEM_ATTRS) + "\n" + _REPORT_SELECT
SQL["audit_groups"] = _audit_ctes(LINEITEM_BASE, LINEITEM_ATTRS) + (
    "\nSELECT attribute, grp, n, n_pred_pos, n_pos, n_true_pos, round(positive_rate, 6) AS positive_rate, "
    "round(tpr, 6) AS tpr FROM g")
SQL["audit_report"] = _audit_ctes(LINEITEM_BASE, LINEITEM_ATTRS) + (
    "\nSELECT attribute, attribute_type, n_groups, round(dpd, 6) AS dpd, round(eod, 6) AS eod, "
    "CASE WHEN dpd >= 0.05 THEN 'FLAGGED' ELSE 'OK' END AS dpd_status, "
    "CASE WHEN eod >= 0.05 THEN 'FLAGGED' ELSE 'OK' END AS eod_status, "
    "(dpd >= 0.05 OR eod >= 0.05) AS any_breach FROM r")
SQL["audit_summary"] = _audit_ctes(LINEITEM_BASE, LINEITEM_ATTRS) + (
    "\nSELECT 0.05 AS threshold, count(*) AS attributes_audited, "
    "CAST(sum(CAST(dpd >= 0.05 AS INTEGER) + CAST(eod >= 0.05 AS INTEGER)) AS BIGINT) AS total_breaches, "
    "CAST(CASE WHEN bool_or(dpd >= 0.05 OR eod >= 0.05) THEN (SELECT count(*) FROM base) ELSE 0 END AS BIGINT) "
    "AS entities_flagged, (SELECT count(*) FROM base) AS entities_total, true AS all_findings_reported FROM r")
SQL["audit_documents"] = _audit_ctes(DOCS_BASE, DOCS_ATTRS) + "\n" + _REPORT_SELECT
SQL["audit_text"] = _audit_ctes(
    f"SELECT concat_ws('-', l_partkey, l_orderkey, l_linenumber) AS line_name, {_pred_sql(LINEITEM_SCORE)} AS pred, "
    "CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS y FROM lineitem",
    [("line_name", "name", "ordinal_bins")]) + "\n" + _REPORT_SELECT
SQL["audit_customer"] = _audit_ctes(CUSTOMER_BASE, CUSTOMER_ATTRS) + "\n" + _REPORT_SELECT
SQL["entity_bias_flag"] = _audit_ctes(CUSTOMER_BASE, CUSTOMER_ATTRS, key="c_custkey") + (
    ",\nflags AS (SELECT attribute, dpd >= 0.05 AS df, eod >= 0.05 AS ef, dpd_max_group, dpd_min_group, "
    "eod_max_group, eod_min_group FROM r),\n"
    "hot AS (SELECT attribute, dpd_max_group AS grp FROM flags WHERE df UNION "
    "SELECT attribute, dpd_min_group FROM flags WHERE df UNION "
    "SELECT attribute, eod_max_group FROM flags WHERE ef UNION "
    "SELECT attribute, eod_min_group FROM flags WHERE ef)\n"
    "SELECT long.c_custkey, (SELECT bool_or(df OR ef) FROM flags) AS bias_flag, "
    "bool_or(hot.grp IS NOT NULL) AS bias_flag_group "
    "FROM long LEFT JOIN hot ON long.attribute = hot.attribute AND long.grp = hot.grp "
    "GROUP BY long.c_custkey")


# --------------------------------------------------------------------------- attribution


def _display_sql(x: str) -> str:
    s = f"regexp_replace({x}, '([a-z])([A-Z])', '\\1 \\2', 'g')"
    s = f"translate({s}, '_-', '  ')"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    return f"lower(trim({s}))"


def _phi_cols(model, src: str) -> tuple[str, list[str]]:
    """CTE m with means over ``src`` and the phi expressions per feature."""
    _a, coefs = model
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}"
                      for c in coefs)
    phis = [f"({b!r} * (CAST({c} AS DOUBLE) - m_{c}))" for c, b in coefs.items()]
    return f"m AS (SELECT {means} FROM {src})", phis


def _factor_list(model, phis) -> str:
    _a, coefs = model
    items = ", ".join(
        f"{{'neg_mag': -abs({p}), 'neg_idx': {-i}, 'feature': '{c}', 'v': {p}}}"
        for i, (c, p) in enumerate(zip(coefs, phis)))
    return f"list_sort([{items}])"


def _reason_sql(top: str, tier: str) -> str:
    ph = (f"list_transform({top}, lambda s: CASE WHEN s.v > 0 THEN {_display_sql('s.feature')} "
          f"ELSE '(mitigating) ' || {_display_sql('s.feature')} END)")
    def body(t3, t2, t1, empty):
        return (f"CASE WHEN len({ph}) >= 3 THEN {t3} WHEN len({ph}) = 2 THEN {t2} "
                f"WHEN len({ph}) = 1 THEN {t1} ELSE '{empty}' END")
    a, b, c = f"{ph}[1]", f"{ph}[2]", f"{ph}[3]"
    high = body(f"'High risk due to ' || {a} || ', ' || {b} || ', and ' || {c} || '.'",
                f"'High risk due to ' || {a} || ' and ' || {b} || '.'",
                f"'High risk primarily due to ' || {a} || '.'", "High risk.") + \
        " || ' Immediate review recommended.'"
    med = body(f"'Moderate risk influenced by ' || {a} || ', ' || {b} || ', and ' || {c} || '.'",
               f"'Moderate risk influenced by ' || {a} || ' and ' || {b} || '.'",
               f"'Moderate risk influenced by ' || {a} || '.'", "Moderate risk.") + \
        " || ' Review within 30 days advised.'"
    low = body(f"'Low risk. Key factors: ' || {a} || ', ' || {b} || ', and ' || {c} || '.'",
               f"'Low risk. Key factors: ' || {a} || ' and ' || {b} || '.'",
               f"'Low risk. Primary factor: ' || {a} || '.'", "Low risk.") + \
        " || ' No immediate action required.'"
    return (f"CASE WHEN {tier} = 'High' THEN ({high}) WHEN {tier} = 'Medium' THEN ({med}) "
            f"ELSE ({low}) END")


def _tier_sql(score: str) -> str:
    return f"CASE WHEN {score} > 0.7 THEN 'High' WHEN {score} >= 0.4 THEN 'Medium' ELSE 'Low' END"


_M, _PHIS = _phi_cols(LINEITEM_MODEL, "lineitem")
_LI_P = (f"WITH {_M}, p AS (SELECT l_orderkey, l_linenumber, {_score_sql(LINEITEM_MODEL)} AS score, "
         f"{_factor_list(LINEITEM_MODEL, _PHIS)} AS fl, [{', '.join(_PHIS)}] AS phi FROM lineitem, m)")

SQL["linear_attribution"] = (
    f"WITH {_M} SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round({p}, 10) AS phi_{c}" for c, p in zip(LINEITEM_MODEL[1], _PHIS))
    + " FROM lineitem, m")
SQL["top_factors"] = _LI_P + (
    " SELECT l_orderkey, l_linenumber, array_to_string(list_transform(list_slice(fl, 1, 3), "
    "lambda s: s.feature), '|') AS top_factors, fl[1].v AS top_value, "
    "CASE WHEN fl[1].v > 0 THEN 'increases risk' ELSE 'decreases risk' END AS top_direction FROM p")
SQL["global_importance"] = _LI_P + (
    ", gi AS (SELECT " + ", ".join(f"avg(abs(phi[{i + 1}])) AS i{i}" for i in range(len(_PHIS)))
    + " FROM p), lg AS (" + " UNION ALL ".join(
        f"SELECT {i} AS idx, '{c}' AS feature, i{i} AS importance FROM gi"
        for i, c in enumerate(LINEITEM_MODEL[1]))
    + ") SELECT feature, round(importance, 6) AS importance, "
      "round(importance / max(importance) OVER (), 6) AS relative, "
      "row_number() OVER (ORDER BY importance DESC, idx DESC) AS rank FROM lg")
SQL["factor_strength"] = _LI_P + (
    ", t AS (SELECT l_orderkey, l_linenumber, list_slice(fl, 1, 5) AS t FROM p), "
    "u AS (SELECT l_orderkey, l_linenumber, t, greatest(list_max(list_transform(t, lambda s: abs(s.v))), 0.001) "
    "AS big, generate_subscripts(t, 1) AS k FROM t) "
    "SELECT l_orderkey, l_linenumber, CAST(k - 1 AS BIGINT) AS pos, t[k].feature AS feature, "
    "CAST(round(least(abs(t[k].v) / big * 100.0, 100.0), 0) AS BIGINT) AS pct, "
    "CASE WHEN round(least(abs(t[k].v) / big * 100.0, 100.0), 0) > 70 THEN 'Strong' "
    "WHEN round(least(abs(t[k].v) / big * 100.0, 100.0), 0) > 35 THEN 'Moderate' ELSE 'Slight' END "
    "AS strength FROM u")
SQL["reason_text"] = _LI_P + (
    f" SELECT l_orderkey, l_linenumber, {_tier_sql('score')} AS intervention_tier, "
    f"{_reason_sql('list_slice(fl, 1, 3)', _tier_sql('score'))} AS reason_text FROM p")
SQL["reason_text_short"] = _LI_P + (
    f" SELECT l_orderkey, l_linenumber, CAST(l_linenumber % 3 AS INTEGER) AS n_factors, "
    f"{_tier_sql('score')} AS intervention_tier, "
    f"{_reason_sql('list_slice(fl, 1, l_linenumber % 3)', _tier_sql('score'))} AS reason_text FROM p")
SQL["display_names"] = (
    f"SELECT p_partkey, {_display_sql('p_name')} AS name_display, "
    f"{_display_sql('p_brand')} AS brand_display, "
    + _display_sql("concat_ws('_', p_type, p_brand)") + " AS type_display FROM part")

# --------------------------------------------------------------------------- gold

_OM, _OPHIS = _phi_cols(ORDER_MODEL, "f")
_ORDER_PRE = [
    "li AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty, "
    "avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax FROM lineitem GROUP BY l_orderkey)",
    "f AS (SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority, "
    "coalesce(CAST(n_lines AS DOUBLE), 0.0) AS n_lines, coalesce(CAST(sum_qty AS DOUBLE), 0.0) AS sum_qty, "
    "coalesce(CAST(avg_disc AS DOUBLE), 0.0) AS avg_disc, coalesce(CAST(avg_tax AS DOUBLE), 0.0) AS avg_tax "
    "FROM orders LEFT JOIN li ON o_orderkey = l_orderkey)",
    _OM,
    f"s AS (SELECT f.*, {_score_sql(ORDER_MODEL)} AS risk, "
    f"CASE WHEN {_score_sql(ORDER_MODEL)} >= 0.5 THEN 1 ELSE 0 END AS pred, "
    "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, "
    f"list_slice({_factor_list(ORDER_MODEL, _OPHIS)}, 1, 3) AS fl FROM f, m)",
]
_GOLD_CTES = _audit_ctes("SELECT * FROM s", [("o_orderpriority", "priority", "plain_str")],
                         prelude=_ORDER_PRE) + (
    ",\ngold AS (SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, round(risk, 4) AS risk_score, "
    "'[' || array_to_string(list_transform(fl, lambda s: chr(39) || s.feature || chr(39)), ', ') || ']' "
    f"AS top_factors, {_reason_sql('fl', _tier_sql('risk'))} AS reason_text, "
    f"{_tier_sql('risk')} AS intervention_tier, "
    "coalesce((SELECT bool_or(dpd >= 0.05 OR eod >= 0.05) FROM r), false) AS bias_flag FROM s)\n")
_GOLD_COLS = "entity_id, risk_score, top_factors, reason_text, intervention_tier, bias_flag"


def _summary_sql(where: str, page_size: int) -> str:
    return _GOLD_CTES + (
        "SELECT count(*) AS total_entities, count_if(intervention_tier = 'High') AS high_risk_count, "
        "count_if(intervention_tier = 'Medium') AS medium_risk_count, "
        "count_if(intervention_tier = 'Low') AS low_risk_count, count_if(bias_flag) AS bias_flagged, "
        f"CAST((count(*) + {page_size - 1}) // {page_size} AS BIGINT) AS total_pages, "
        "round(coalesce(avg(CAST(bias_flag AS DOUBLE)), 0.0), 6) AS bias_rate, "
        f"round(coalesce(avg(risk_score), 0.0), 6) AS avg_risk_score FROM gold {where}")


SQL["gold_table"] = _GOLD_CTES + f"SELECT {_GOLD_COLS} FROM gold"
SQL["gold_flagged"] = ("SELECT CAST(c_custkey AS VARCHAR) AS entity_id, true AS bias_flag FROM ("
                       + SQL["entity_bias_flag"] + ") WHERE bias_flag_group")
SQL["gold_sinks"] = _GOLD_CTES + (
    ", one AS (SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities, "
    "round(sum(risk_score), 3) AS total_score, "
    "'bias_flag,entity_id,intervention_tier,reason_text,risk_score,top_factors' AS columns FROM gold) "
    "SELECT sink, one.* FROM one, (VALUES ('parquet'), ('json'), ('csv')) f(sink)")
SQL["ingest_csv"] = ("SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, o_orderstatus, "
                     "'double' AS price_type FROM orders")
SQL["cached_dataset"] = "SELECT c_custkey, c_name, round(c_acctbal, 6) AS c_acctbal FROM customer"
# a fitted model cannot be recomputed in SQL; what must hold of it for every row can be stated
SQL["lr_optimum"] = ("SELECT count(*) AS n_rows, true AS n_chars_zero, true AS quality_zero, true AS intercept_zero "
                     "FROM documents JOIN labels USING (doc_id)")
SQL["gold_page"] = _GOLD_CTES + (
    f"SELECT {_GOLD_COLS} FROM gold WHERE intervention_tier = 'Medium' "
    "ORDER BY risk_score DESC, entity_id ASC LIMIT 50 OFFSET 100")
SQL["gold_pages"] = _GOLD_CTES + (
    "SELECT CAST((n + 49) // 50 AS INTEGER) AS page, entity_id, risk_score, intervention_tier FROM ("
    f"SELECT *, row_number() OVER (ORDER BY risk_score DESC, entity_id) AS n, count(*) OVER () AS total FROM ("
    f"SELECT {_GOLD_COLS} FROM gold)) WHERE (n + 49) // 50 IN (1, ((total + 49) // 50 + 1) // 2, (total + 49) // 50)")
SQL["gold_summary"] = _summary_sql("", 50)
SQL["gold_summary_filtered"] = _summary_sql("WHERE intervention_tier = 'High'", 20)
SQL["tier_share"] = _GOLD_CTES + (
    "SELECT intervention_tier, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct "
    "FROM gold GROUP BY intervention_tier")
SQL["entity_lookup"] = _GOLD_CTES + (
    f"SELECT {_GOLD_COLS} FROM gold WHERE entity_id IN "
    "(SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'R')")
SQL["lookup_plain"] = SQL["entity_lookup"]
SQL["stage_join"] = _GOLD_CTES + (
    ", lines AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) "
    "SELECT entity_id, risk_score, intervention_tier, round(CAST(o_totalprice AS DOUBLE), 6) AS o_totalprice, "
    "CAST(coalesce(n, 0) AS DOUBLE) AS n_lines, round(CAST(coalesce(qty, 0) AS DOUBLE), 6) AS sum_qty "
    "FROM gold JOIN orders ON entity_id = CAST(o_orderkey AS VARCHAR) LEFT JOIN lines ON l_orderkey = o_orderkey")
SQL["entity_index"] = (
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx, "
    "printf('ENT-%05d', row_number() OVER (ORDER BY o_orderkey) - 1) AS entity_id FROM orders")


# --------------------------------------------------------------------------- profile

_ORDERS_COLS = [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True),
                ("o_orderstatus", "string", False), ("o_totalprice", "double", True),
                ("o_orderdate", "timestamp_ntz", False), ("o_orderpriority", "string", False)]


def _profile_sql(tbl: str, cols) -> str:
    parts = []
    for i, (c, dt, num) in enumerate(cols):
        x = f"CAST({c} AS DOUBLE)"
        stat = (lambda f: f"round({f}({x}), 6)") if num else (lambda f: "CAST(NULL AS DOUBLE)")
        med = f"round(quantile_cont({x}, 0.5), 6)" if num else "CAST(NULL AS DOUBLE)"
        order = f"{x}, CAST({c} AS VARCHAR)" if num else f"CAST({c} AS VARCHAR)"
        sample = (f"(SELECT string_agg(t, '|' ORDER BY {'n, ' if num else ''}t) FROM "
                  f"(SELECT DISTINCT {x + ' AS n, ' if num else ''}CAST({c} AS VARCHAR) AS t "
                  f"FROM {tbl} WHERE {c} IS NOT NULL ORDER BY {order.replace(x, 'n') if num else 't'} "
                  f"LIMIT 5))")
        parts.append(
            f"SELECT '{c}' AS \"column\", {i} AS position, '{dt}' AS dtype, count(*) AS total_count, "
            f"count(*) - count({c}) AS null_count, round((count(*) - count({c})) / greatest(count(*), 1), 6) "
            f"AS null_pct, count(DISTINCT {c}) AS cardinality, "
            f"round(count(DISTINCT {c}) / greatest(count(*), 1), 6) AS unique_ratio, "
            f"(count(DISTINCT {c}) / greatest(count(*), 1) > 0.95 AND count(*) > 10) AS is_likely_id, "
            f"count(DISTINCT {c}) <= 2 AS is_binary, count(DISTINCT {c}) <= 15 AS is_low_cardinality, "
            f"{'true' if num else 'false'} AS is_numeric, {stat('min')} AS min, {stat('max')} AS max, "
            f"{stat('avg')} AS mean, {med} AS median, {stat('stddev_samp')} AS std, "
            f"{sample} AS sample_values FROM {tbl}")
    return " UNION ALL ".join(parts)


SQL["profile_orders"] = _profile_sql("orders", _ORDERS_COLS)
SQL["validate_orders"] = (
    "SELECT count(*) AS total_rows, 6 AS total_columns, "
    "CAST(" + " + ".join(f"count_if({c} IS NULL)" for c, _, _ in _ORDERS_COLS) + " AS BIGINT) AS total_nulls, "
    "(" + " + ".join(f"count_if({c} IS NULL)" for c, _, _ in _ORDERS_COLS) + ") > 0 AS has_nulls, "
    "count(*) >= 50 AS valid, CASE WHEN count(*) < 50 THEN 'Dataset too small: ' || count(*) || "
    "' rows (minimum 50 expected)' ELSE '' END AS issues, "
    + " || ';' || ".join(f"'{c}=' || count_if({c} IS NULL)" for c, _, _ in sorted(_ORDERS_COLS))
    + " AS null_counts FROM orders")
SQL["validate_nations"] = (
    "SELECT count(*) AS total_rows, 3 AS total_columns, "
    "CAST(count_if(n_nationkey IS NULL) + count_if(n_name IS NULL) + count_if(n_regionkey IS NULL) AS BIGINT) "
    "AS total_nulls, (count_if(n_nationkey IS NULL) + count_if(n_name IS NULL) + "
    "count_if(n_regionkey IS NULL)) > 0 AS has_nulls, count(*) >= 50 AS valid, "
    "CASE WHEN count(*) < 50 THEN 'Dataset too small: ' || count(*) || ' rows (minimum 50 expected)' "
    "ELSE '' END AS issues FROM nation")
SQL["feature_stats"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
    f"round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS median, "
    f"round(stddev_samp({c}), 6) AS std FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


# --------------------------------------------------------------------------- silver


def _minority(tbl, c):
    return (f"WITH cc AS (SELECT {c} AS v, count(*) AS n FROM {tbl} WHERE {c} IS NOT NULL GROUP BY 1), "
            "pos AS (SELECT v FROM cc ORDER BY n, v LIMIT 1) ")


SQL["binarize_minority"] = _minority("lineitem", "l_linestatus") + (
    "SELECT l_linestatus, CASE WHEN l_linestatus = (SELECT v FROM pos) THEN 1 ELSE 0 END AS target_binary, "
    "count(*) AS n FROM lineitem GROUP BY ALL")
SQL["binarize_multi"] = (
    "WITH cc AS (SELECT o_orderstatus AS v, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1), "
    "maj AS (SELECT v FROM cc ORDER BY n DESC, v LIMIT 1) "
    "SELECT o_orderstatus, CASE WHEN o_orderstatus IS NULL OR o_orderstatus <> (SELECT v FROM maj) "
    "THEN 1 ELSE 0 END AS target_binary, count(*) AS n FROM orders GROUP BY ALL")
SQL["binarize_explicit"] = (
    "SELECT o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS target_binary, "
    "count(*) AS n FROM orders GROUP BY ALL")
SQL["binarize_median"] = (
    "SELECT o_orderkey, CASE WHEN o_totalprice > (SELECT quantile_cont(o_totalprice, 0.5) FROM orders) "
    "THEN 1 ELSE 0 END AS target_binary FROM orders")
SQL["binarize_two_valued"] = (
    "SELECT quality, CASE WHEN quality = (SELECT max(quality) FROM labels) THEN 1 ELSE 0 END AS target_binary, "
    "count(*) AS n FROM labels GROUP BY ALL")
SQL["binarize_coerce"] = (
    "SELECT p_partkey, "
    "CASE WHEN TRY_CAST(p_name AS DOUBLE) > (SELECT quantile_cont(TRY_CAST(p_name AS DOUBLE), 0.5) FROM part) "
    "THEN 1 ELSE 0 END AS name_binary, "
    "CASE WHEN CAST(p_size AS DOUBLE) > (SELECT quantile_cont(CAST(p_size AS DOUBLE), 0.5) FROM part) "
    "THEN 1 ELSE 0 END AS size_binary FROM part")
_GAPS = ("gaps AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice, "
         "CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS o_custkey, "
         "CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 4 <> 0 THEN o_totalprice / 2 END AS half_price, "
         "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus, "
         "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders)")


def _mode(c):
    return (f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM gaps WHERE {c} IS NOT NULL GROUP BY 1) "
            "ORDER BY n DESC, v LIMIT 1)")


SQL["impute_median_mode"] = (
    f"WITH {_GAPS} SELECT o_orderkey, "
    "round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM gaps)), 6) AS o_totalprice, "
    "round(coalesce(CAST(o_custkey AS DOUBLE), (SELECT quantile_cont(CAST(o_custkey AS DOUBLE), 0.5) FROM gaps)), 6) "
    "AS o_custkey, "
    "round(coalesce(half_price, (SELECT quantile_cont(half_price, 0.5) FROM gaps)), 6) AS half_price, "
    f"coalesce(o_orderstatus, {_mode('o_orderstatus')}) AS o_orderstatus, "
    f"coalesce(o_orderpriority, {_mode('o_orderpriority')}) AS o_orderpriority FROM gaps")
SQL["text_modes"] = (
    "WITH o AS (SELECT o_orderpriority, CASE WHEN o_orderkey % 20 < 3 THEN 'none' ELSE concat_ws(' ', o_orderkey, "
    "o_custkey) END AS note, CASE WHEN o_orderkey % 2 = 0 THEN 'b' ELSE 'a' END AS side, '#' || o_orderkey AS name "
    "FROM orders), l AS (UNPIVOT o ON o_orderpriority, note, side, name INTO NAME \"column\" VALUE v) "
    "SELECT \"column\", first(v ORDER BY n DESC, v) AS mode FROM (SELECT \"column\", v, count(*) AS n FROM l "
    "GROUP BY 1, 2) GROUP BY 1")
SQL["delta_ratio_flags"] = (
    "WITH u AS (SELECT user_id, count_if(day(ts) <= 15) AS events_1, count_if(day(ts) > 15) AS events_2, "
    "sum(CASE WHEN day(ts) <= 15 THEN value ELSE 0.0 END) AS value_1, "
    "sum(CASE WHEN day(ts) > 15 THEN value ELSE 0.0 END) AS value_2, "
    "count_if(event_type = 'click') AS checkout_started, count_if(event_type = 'purchase') AS checkout_completed, "
    "CAST(count_if(event_type = 'error') >= 14 AS INTEGER) AS many_errors, "
    "CAST(count_if(event_type = 'purchase') >= 14 AS INTEGER) AS frequent_buyer, "
    "CAST(max(value) >= 250 AS INTEGER) AS big_ticket FROM events GROUP BY user_id) "
    "SELECT user_id, CAST(events_2 - events_1 AS BIGINT) AS delta_events, round(value_2 - value_1, 6) AS delta_value, "
    "round(CASE WHEN checkout_started = 0 THEN 0.0 ELSE checkout_completed / checkout_started END, 6) "
    "AS ratio_checkout, CAST(many_errors + frequent_buyer + big_ticket AS BIGINT) AS binary_flag_sum FROM u")
SQL["ordinal_codes"] = (
    "SELECT p_partkey, "
    "CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS p_name_code, "
    "CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_code, "
    "CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type_code FROM part")

SQL["ordinal_codes_split"] = (
    "WITH o AS (SELECT o_orderkey, 'order ' || o_orderkey AS label, "
    "CASE WHEN o_orderkey % 2 = 0 THEN 'customer ' || o_custkey END AS buyer, o_orderpriority AS priority FROM orders) "
    "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_code, "
    "CASE WHEN buyer IS NULL THEN -1 ELSE CAST(dense_rank() OVER (ORDER BY buyer NULLS LAST) - 1 AS INTEGER) END "
    "AS buyer_code, CAST(dense_rank() OVER (ORDER BY priority) - 1 AS INTEGER) AS priority_code FROM o")

# --------------------------------------------------------------------------- discovery

from .oracle_discovery import SQL as _DISCOVERY_SQL  # noqa: E402

SQL.update(_DISCOVERY_SQL)

from .oracle_eval import SQL as _EVAL_SQL  # noqa: E402

SQL.update(_EVAL_SQL)

from .oracle_more import SQL as _MORE_SQL  # noqa: E402

SQL.update(_MORE_SQL)
from .oracle_models import SQL as _MODEL_SQL  # noqa: E402
SQL.update(_MODEL_SQL)
SQL["importance_sink"] = SQL["global_importance"]
SQL["metrics_log"] = (
    f"SELECT 'run-1' AS run_id, 'confusion' AS stage, key, CAST(value AS DOUBLE) AS value FROM (UNPIVOT "
    f"({SQL['confusion']}) ON tn, fp, fn, tp INTO NAME key VALUE value)")
