"""DuckDB statements for what holds of fitted models, and for the first boosted tree (see :mod:`.oracle`)."""

from __future__ import annotations

from .catalog import BOOST_FEATURES

_LABELLED = "FROM documents JOIN labels USING (doc_id)"


def _split_ctes(level: str, rows: str) -> str:
    """Best split of every node of ``rows`` (node, features, g, h): gains at every value of every feature."""
    long = " UNION ALL ".join(
        f"SELECT node, {i} AS f, CAST({c} AS DOUBLE) AS v, sum(g) AS g, sum(h) AS h FROM {rows} GROUP BY 1, 2, 3"
        for i, c in enumerate(BOOST_FEATURES))
    return f"""
v{level} AS ({long}),
c{level} AS (
  SELECT node, f, v, sum(g) OVER below AS gl, sum(h) OVER below AS hl, sum(g) OVER whole AS gt, sum(h) OVER whole AS ht
  FROM v{level}
  WINDOW below AS (PARTITION BY node, f ORDER BY v), whole AS (PARTITION BY node, f)),
s{level} AS (
  SELECT node, f, v, ht, gt, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) AS gain
  FROM c{level} WHERE hl >= 1 AND ht - hl >= 1
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)"""


def _moved(split: str, rows: str) -> str:
    at = "CASE s.f " + " ".join(f"WHEN {i} THEN r.{c}" for i, c in enumerate(BOOST_FEATURES)) + " END"
    return (f"SELECT r.* EXCLUDE (node), 2 * r.node + CASE WHEN {at} <= s.v THEN 1 ELSE 2 END AS node "
            f"FROM {rows} r JOIN {split} s ON s.node = r.node WHERE s.gain > 1e-6")


_NAMES = "[" + ", ".join(f"'{c}'" for c in BOOST_FEATURES) + "]"

SQL: dict[str, str] = {
    "boost_first_tree": f"""
WITH d AS (SELECT {", ".join(BOOST_FEATURES)}, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
w AS (SELECT sum(1 - y) / greatest(sum(y), 1)::DOUBLE AS up FROM d),
r0 AS (
  SELECT d.* EXCLUDE (y), 0 AS node, CASE WHEN y = 1 THEN up ELSE 1 END * (0.5 - y)::DOUBLE AS g,
    CASE WHEN y = 1 THEN up ELSE 1 END * 0.25::DOUBLE AS h
  FROM d, w),{_split_ctes("0", "r0")},
r1 AS ({_moved("s0", "r0")}),{_split_ctes("1", "r1")},
r2 AS ({_moved("s1", "r1")}),
t AS (
  SELECT node, sum(g) AS g, sum(h) AS h FROM (
    SELECT node, g, h FROM r0 UNION ALL SELECT node, g, h FROM r1 UNION ALL SELECT node, g, h FROM r2) GROUP BY node),
s AS (SELECT node, f, v, gain FROM s0 WHERE gain > 1e-6 UNION ALL SELECT node, f, v, gain FROM s1 WHERE gain > 1e-6)
SELECT t.node, ({_NAMES})[s.f + 1] AS feature, s.v AS threshold, round(coalesce(s.gain, 0), 3) AS gain,
  round(t.h, 3) AS cover, round(-0.1::DOUBLE * t.g / (t.h + 1), 6) AS value
FROM t LEFT JOIN s ON s.node = t.node""",
    "boost_loss": f"SELECT count(*) AS n_rows, true AS prob_ok, true AS loss_fell {_LABELLED}",
    "calibrated_mean": f"SELECT doc_id, CAST(5 AS BIGINT) AS folds, true AS mean_ok {_LABELLED}",
    "tree_shap_sums": f"SELECT doc_id, true AS sum_ok {_LABELLED}",
    "run_gold_rows": (f"SELECT CAST(doc_id AS VARCHAR) AS entity_id, CAST(1 AS BIGINT) AS n_rows, true AS tier_ok, "
                      f"true AS factors_ok {_LABELLED}"),
    "fit_score_rf": (f"SELECT doc_id, true AS vote_ok, true AS in_range, true AS decision_ok, true AS tier_ok "
                     f"{_LABELLED}"),
}

# sinks: what is read back from the committed version
SQL["silver_sink"] = (
    "SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment, "
    "count(*) OVER (PARTITION BY c_mktsegment) AS n_segment FROM customer")
SQL["preview"] = (
    "SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_orderstatus', 'string'), (2, 'o_totalprice', 'double')) "
    "AS t(position, \"column\", dtype), (SELECT count(*) AS n_rows, least(count(*), 5) AS n_preview FROM orders)")
