"""DuckDB statements for the evaluation and mitigation queries (see :mod:`.oracle`)."""

from __future__ import annotations

from .catalog import DOCUMENT_SCORE, DOCUMENT_SCORE_B, LINEITEM_SCORE, PLATT_AB


def score_sql(spec) -> str:
    a, coefs = spec
    z = " + ".join([repr(a)] + [f"{b!r} * CAST({c} AS DOUBLE)" for c, b in coefs.items()])
    return f"(1.0 / (1.0 + exp(-({z}))))"


def pred_sql(spec) -> str:
    return f"(CASE WHEN {score_sql(spec)} >= 0.5 THEN 1 ELSE 0 END)"


DOCS = (f"docs AS (SELECT l.toxic AS y, {score_sql(DOCUMENT_SCORE)} AS s_lr, {pred_sql(DOCUMENT_SCORE)} AS pred, "
        f"{score_sql(DOCUMENT_SCORE_B)} AS s_gbt FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")
CONF = ("conf AS (SELECT count_if(y = 0 AND pred = 0) AS tn, count_if(y = 0 AND pred = 1) AS fp, "
        "count_if(y = 1 AND pred = 0) AS fn, count_if(y = 1 AND pred = 1) AS tp FROM docs)")
AUCS = ("long AS (SELECT 'logistic_regression' AS model, s_lr AS s, y FROM docs UNION ALL "
        "SELECT 'gbt', s_gbt, y FROM docs), "
        "ps AS (SELECT model, s, sum(y) AS pos, sum(1 - y) AS neg FROM long GROUP BY model, s), "
        "cs AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS below FROM ps), "
        "aucs AS (SELECT model, sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc "
        "FROM cs GROUP BY model)")


def _div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF({b}, 0), 0.0)"


def _stats(col: str) -> str:
    return (f"avg(pow({col} - y, 2)) AS brier, avg({col}) AS mean, stddev_pop({col}) AS std, "
            f"min({col}) AS min, max({col}) AS max, quantile_cont({col}, 0.5) AS median")


_R = "round({0}, 6) AS {0}"
STAT_COLS = ", ".join(_R.format(c) for c in ("brier", "mean", "std", "min", "max", "median"))

LI = (f"b AS (SELECT l_returnflag AS grp, {score_sql(LINEITEM_SCORE)} AS score, {pred_sql(LINEITEM_SCORE)} AS pred, "
      "CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS y FROM lineitem)")

SQL: dict[str, str] = {
    "confusion": f"WITH {DOCS}, {CONF} SELECT tn, fp, fn, tp FROM conf",
    "classification_metrics": (
        f"WITH {DOCS}, {CONF} SELECT tn, fp, fn, tp, round({_div('tp + tn', 'tp + tn + fp + fn')}, 6) AS accuracy, "
        f"round({_div('tp', 'tp + fp')}, 6) AS precision, round({_div('tp', 'tp + fn')}, 6) AS recall, "
        f"round({_div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM conf"),
    "auc_exact": f"WITH {DOCS}, {AUCS} SELECT model, round(auc, 6) AS auc FROM aucs",
    "best_model": (
        f"WITH {DOCS}, {AUCS} SELECT arg_max(model, (auc, CASE model WHEN 'gbt' THEN 2 ELSE 0 END)) AS best_model, "
        "round(max(auc), 6) AS best_auc FROM aucs"),
    "brier_stats": (
        f"WITH {DOCS}, st AS (SELECT 'logistic_regression' AS model, {_stats('s_lr')} FROM docs UNION ALL "
        f"SELECT 'gbt', {_stats('s_gbt')} FROM docs) "
        f"SELECT model, {STAT_COLS}, round(((SELECT brier FROM st WHERE model = 'logistic_regression') - brier) / "
        "greatest((SELECT brier FROM st WHERE model = 'logistic_regression'), 1e-10) * 100.0, 6) AS improvement_pct "
        "FROM st"),
    "class_weights": (
        f"WITH {DOCS}, c AS (SELECT CAST(y AS BIGINT) AS label, count(*) AS n FROM docs GROUP BY 1) "
        "SELECT label, n, round((SELECT sum(n) FROM c) / (2.0 * n), 6) AS balanced_weight, "
        "round(CAST(coalesce((SELECT n FROM c WHERE label = 0), 0) AS DOUBLE) / "
        "greatest(coalesce((SELECT n FROM c WHERE label = 1), 0), 1), 6) AS scale_pos_weight FROM c"),
    "platt_apply": (
        f"WITH {DOCS}, cal AS (SELECT y, 1.0 / (1.0 + exp(-({PLATT_AB[0]!r} * s_lr + {PLATT_AB[1]!r}))) AS p "
        f"FROM docs), st AS (SELECT {_stats('p')} FROM cal) SELECT {STAT_COLS} FROM st"),
    "reweigh": (
        f"WITH {LI}, g AS (SELECT grp, y AS label, count(*) AS n FROM b GROUP BY 1, 2) "
        "SELECT grp, label, n, round(CAST(sum(n) OVER (PARTITION BY grp) * sum(n) OVER (PARTITION BY label) AS DOUBLE)"
        " / CAST(sum(n) OVER () * n AS DOUBLE), 6) AS weight FROM g"),
    "group_thresholds": (
        f"WITH {LI}, r AS (SELECT 1.0 - avg(CAST(pred AS DOUBLE)) AS q FROM b), "
        "s AS (SELECT grp, list_sort(list(score)) AS v, count(*) AS n FROM b GROUP BY grp), "
        "p AS (SELECT grp, v, (SELECT q FROM r) * (n - 1) AS pos FROM s), "
        "t AS (SELECT grp, CASE WHEN v[CAST(floor(pos) AS BIGINT) + 1] = v[CAST(ceil(pos) AS BIGINT) + 1] "
        "THEN v[CAST(floor(pos) AS BIGINT) + 1] ELSE v[CAST(floor(pos) AS BIGINT) + 1] + "
        "(v[CAST(ceil(pos) AS BIGINT) + 1] - v[CAST(floor(pos) AS BIGINT) + 1]) * (pos - floor(pos)) END "
        "AS threshold FROM p) "
        "SELECT t.grp, round(t.threshold, 6) AS threshold, "
        "round(avg(CASE WHEN b.score > t.threshold THEN 1.0 ELSE 0.0 END), 6) AS adjusted_rate, "
        "round(avg(CAST(b.pred AS DOUBLE)), 6) AS original_rate FROM t JOIN b ON t.grp = b.grp "
        "GROUP BY t.grp, t.threshold"),
}
