"""Registered queries over the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the DuckDB statement of the same name in :mod:`.oracle`. Doubles are
rounded to 6 places in both, and every computed column is aliased.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import decide, linear_score, platt
from ..functions.text import display_name, entity_id, intervention_tier, python_list_text, reason_text
from ..operators.attribution import (factor_names, factor_strength, global_importance,
                                     linear_attribution, strength_label, top_factors)
from ..operators.audit import fairness_audit
from ..operators.discovery import discover
from ..operators.evaluate import (best_model, class_weights, classification_metrics, confusion,
                                  evaluate, improvement_pct, metrics_table, roc_auc, score_stats)
from ..operators.mitigation import apply_thresholds, group_thresholds, reweighing_weights
from ..operators.models import calibrate_cv, fit, in_parallel, stratified_split, with_weights
from ..operators.scenarios import baseline, grid, score_scenarios
from ..operators.treeshap import extract_trees, tree_shap, tree_sum
from ..streaming.monitor import bias_by_window, run_monitor
from ..streaming.values import bias_by_value_window, run_value_monitor
from ..operators.gold import build_gold, entity_lookup, filter_gold, gold_index, gold_page, gold_summary, tier_share
from ..operators.profile import feature_stats, profile_columns
from ..operators.silver import (TARGET, code_tables, column_modes, encode, engineer_features, impute, plan_features,
                                prepare_target, split_codes)
from ..sources.ingest import (cached_dataset, ingest, metrics_rows, preview, validate, write_gold,
                              write_silver)
from ..sources.versions import Versions, publish, read_metrics, replace_metrics
from .prefix import row_index
from ..session import (checkpoint_dir, default_parallelism, parquet_handover, scratch_folder,
                       shared_root)
from ..sources.bucketed import bucketed_table
from ..sources.tables import TABLES, table

# Literal score coefficients shared with the oracle statements.
# Boundaries sit between representable prices, so no row is on a rounding edge.
LINEITEM_SCORE = (-5.3000005, {"l_extendedprice": 0.0001})
DOCUMENT_SCORE = (-1.4750005, {"n_chars": 0.001})
CUSTOMER_SCORE = (-2.2500005, {"c_acctbal": 0.0005})

R6 = 6


def _r(c: str, name: str | None = None):
    return F.round(F.col(c), R6).alias(name or c)


# --------------------------------------------------------------------------- audit

def scored_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    a, b = LINEITEM_SCORE
    return li.select("l_returnflag", "l_linestatus", "l_quantity",
                     decide(linear_score(a, b)).alias("pred"),
                     F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("y"))


LINEITEM_SENSITIVE = [("l_returnflag", "status"), ("l_linestatus", "status"),
                      ("l_quantity", "quantity")]


def audit_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    res = fairness_audit(scored_lineitem(spark, sf), LINEITEM_SENSITIVE, "pred", "y")
    return _report_cols(res.report)


def _report_cols(report: DataFrame) -> DataFrame:
    return report.select(
        "attribute", "attribute_type", F.col("n_groups").cast("long").alias("n_groups"),
        F.col("n_rows").cast("long").alias("n_rows"), _r("dpd"), _r("eod"),
        "dpd_max_group", "dpd_min_group", "eod_max_group", "eod_min_group",
        "dpd_flagged", "eod_flagged", "any_breach")


def audit_groups(spark: SparkSession, sf: str) -> DataFrame:
    res = fairness_audit(scored_lineitem(spark, sf), LINEITEM_SENSITIVE, "pred", "y")
    return res.groups.select("attribute", "grp", "n", "n_pred_pos", "n_pos", "n_true_pos",
                             _r("positive_rate"), _r("tpr"))


def audit_report(spark: SparkSession, sf: str) -> DataFrame:
    res = fairness_audit(scored_lineitem(spark, sf), LINEITEM_SENSITIVE, "pred", "y")
    t = res.report_table()
    return t.select("attribute", "attribute_type", F.col("n_groups").cast("long").alias("n_groups"),
                    _r("dpd"), _r("eod"), "dpd_status", "eod_status", "any_breach")


def audit_summary(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_lineitem(spark, sf)
    res = fairness_audit(scored, LINEITEM_SENSITIVE, "pred", "y")
    return res.summary(scored)


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """documents joined to labels on the key (text is never read)."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    a, b = DOCUMENT_SCORE
    return docs.join(labels, "doc_id", "inner").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic",
        linear_score(a, b).alias("score"), decide(linear_score(a, b)).alias("pred"))


def audit_documents(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled_documents(spark, sf)
    res = fairness_audit(df, [("lang", "language"), ("source", "origin")], "pred", "toxic")
    return _report_cols(res.report)


def scored_customer(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    a, b = CUSTOMER_SCORE
    return c.select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal",
                    decide(linear_score(a, b)).alias("pred"),
                    F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), 1)
                     .otherwise(0).alias("y"))


CUSTOMER_SENSITIVE = [("c_mktsegment", "segment"), ("c_nationkey", "nationality"),
                      ("c_acctbal", "socioeconomic")]


def entity_bias_flag(spark: SparkSession, sf: str) -> DataFrame:
    df = scored_customer(spark, sf)
    res = fairness_audit(df, CUSTOMER_SENSITIVE, "pred", "y")
    wide = res.entity_flags(df, scope="attribute", name="bias_flag")
    wide = res.entity_flags(wide, scope="group", name="bias_flag_group")
    return wide.select("c_custkey", "bias_flag", "bias_flag_group")


def audit_customer(spark: SparkSession, sf: str) -> DataFrame:
    res = fairness_audit(scored_customer(spark, sf), CUSTOMER_SENSITIVE, "pred", "y")
    return _report_cols(res.report)


def audit_text(spark: SparkSession, sf: str) -> DataFrame:
    """Audit by rank quartiles of a text column in which every value is its own."""
    a, b = LINEITEM_SCORE
    df = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_partkey", "l_orderkey", "l_linenumber").alias("line_name"),
        decide(linear_score(a, b)).alias("pred"), F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("y"))
    return _report_cols(fairness_audit(df, [("line_name", "name")], "pred", "y").report)


# --------------------------------------------------------------------------- attribution

# Literal logistic coefficients for the attribution queries.
LINEITEM_MODEL = (-1.2, {"l_quantity": 0.03, "l_extendedprice": 0.00002,
                         "l_discount": -8.0, "l_tax": 5.0})


def attributed_lineitem(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    a, coefs = LINEITEM_MODEL
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *coefs)
    li = li.withColumn("score", linear_score(a, coefs))
    return linear_attribution(li, coefs), list(coefs)


def q_linear_attribution(spark: SparkSession, sf: str) -> DataFrame:
    df, feats = attributed_lineitem(spark, sf)
    return df.select("l_orderkey", "l_linenumber",
                     *[F.round(F.element_at("phi", i + 1), 10).alias(f"phi_{f}") for i, f in enumerate(feats)])


def q_top_factors(spark: SparkSession, sf: str) -> DataFrame:
    df, feats = attributed_lineitem(spark, sf)
    top = top_factors(F.col("phi"), feats, 3)
    return df.select("l_orderkey", "l_linenumber", top.alias("t")).select(
        "l_orderkey", "l_linenumber",
        F.array_join(factor_names(F.col("t")), "|").alias("top_factors"),
        F.col("t")[0]["shap_value"].alias("top_value"),
        F.col("t")[0]["direction"].alias("top_direction"))


def q_global_importance(spark: SparkSession, sf: str) -> DataFrame:
    df, feats = attributed_lineitem(spark, sf)
    gi = global_importance(df, feats, top=20)
    return gi.select("feature", _r("importance"), _r("relative"), F.col("rank").cast("long"))


def q_factor_strength(spark: SparkSession, sf: str) -> DataFrame:
    df, feats = attributed_lineitem(spark, sf)
    top = top_factors(F.col("phi"), feats, 5)
    st = factor_strength(top)
    return df.select("l_orderkey", "l_linenumber", F.posexplode(st).alias("pos", "s")).select(
        "l_orderkey", "l_linenumber", F.col("pos").cast("long").alias("pos"),
        F.col("s.feature").alias("feature"), F.col("s.pct").cast("long").alias("pct"),
        strength_label(F.col("s.pct")).alias("strength"))


def q_reason_text(spark: SparkSession, sf: str) -> DataFrame:
    df, feats = attributed_lineitem(spark, sf)
    top = top_factors(F.col("phi"), feats, 3)
    tier = intervention_tier(F.col("score"))
    return df.select("l_orderkey", "l_linenumber", tier.alias("intervention_tier"),
                     reason_text(top, tier).alias("reason_text"))


def q_reason_text_short(spark: SparkSession, sf: str) -> DataFrame:
    """Reasons of fewer than three factors: none, one or two of them, by the line's number."""
    df, feats = attributed_lineitem(spark, sf)
    top = F.slice(top_factors(F.col("phi"), feats, 3), 1, (F.col("l_linenumber") % 3).cast("int"))
    tier = intervention_tier(F.col("score"))
    return df.select("l_orderkey", "l_linenumber", F.size(top).alias("n_factors"), tier.alias("intervention_tier"),
                     reason_text(top, tier).alias("reason_text"))


def q_display_names(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select("p_partkey", display_name(F.col("p_name")).alias("name_display"),
                    display_name(F.col("p_brand")).alias("brand_display"),
                    display_name(F.concat_ws("_", "p_type", "p_brand")).alias("type_display"))


# --------------------------------------------------------------------------- gold

# Literal logistic coefficients for the order-level gold table.
ORDER_MODEL = (-1.5, {"o_totalprice": 0.000004, "n_lines": 0.1, "sum_qty": 0.01,
                      "avg_disc": -5.0, "avg_tax": 4.0})


def order_features(spark: SparkSession, sf: str) -> DataFrame:
    """orders joined to their lineitem aggregates (lineitem is reduced on the
    join key first, so the join reuses that partitioning)."""
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_discount").alias("avg_disc"), F.avg("l_tax").alias("avg_tax"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus",
                                           "o_orderpriority")
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
    return j.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
                    *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                      for c in ("n_lines", "sum_qty", "avg_disc", "avg_tax")])


def scored_orders(spark: SparkSession, sf: str) -> DataFrame:
    a, coefs = ORDER_MODEL
    f = order_features(spark, sf)
    f = f.withColumn("risk", linear_score(a, coefs))
    f = f.withColumn("pred", decide(F.col("risk"))).withColumn(
        "y", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    # four jobs read these rows (means, audit counts, group stats, gold), each its own columns of them:
    # write the join once in the shared folder
    f = parquet_handover(f, scratch_folder(spark, "scored"), "orders")
    f = linear_attribution(f, coefs)
    return f.withColumn("factors", top_factors(F.col("phi"), list(coefs), 3))


def gold_orders(spark: SparkSession, sf: str) -> DataFrame:
    f = scored_orders(spark, sf)
    res = fairness_audit(f, [("o_orderpriority", "priority")], "pred", "y")
    flagged = res.entity_flags(f, scope="attribute", name="bias_flag")
    return build_gold(flagged, "risk", "factors", "bias_flag", id_column="o_orderkey")


def _gold_out(g: DataFrame) -> DataFrame:
    return g.select("entity_id", "risk_score", python_list_text(F.col("top_factors")).alias("top_factors"),
                    "reason_text", "intervention_tier", "bias_flag")


def q_gold_table(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_out(gold_orders(spark, sf))


def q_gold_flagged(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in the group at either end of a breached measure."""
    df = scored_customer(spark, sf)
    res = fairness_audit(df, CUSTOMER_SENSITIVE, "pred", "y")
    flagged = filter_gold(res.entity_flags(df, scope="group", name="bias_flag"), bias_only=True)
    return flagged.select(entity_id(F.col("c_custkey"), "ENT", None).alias("entity_id"), "bias_flag")


def q_gold_page(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_out(gold_page(gold_orders(spark, sf), page=3, page_size=50, tier="Medium",
                               sort_by="risk_score", desc=True))


def q_gold_pages(spark: SparkSession, sf: str) -> DataFrame:
    """First, middle and last page of all gold rows, through one index (150 rows at most, held so that it can go)."""
    gold = gold_orders(spark, sf)
    index = gold_index(gold)
    try:
        last = index.pages(50)
        pages = [index.page(n).select(F.lit(n).alias("page"), "entity_id", "risk_score", "intervention_tier")
                 for n in sorted({1, (last + 1) // 2, last})]
        both = reduce(DataFrame.unionAll, pages)
        return spark.createDataFrame(both.collect(), both.schema)
    finally:
        index.close()


def q_gold_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = gold_summary(gold_orders(spark, sf))
    return s.select(*[c for c in s.columns if c not in ("bias_rate", "avg_risk_score")],
                    _r("bias_rate"), _r("avg_risk_score"))


def q_gold_summary_filtered(spark: SparkSession, sf: str) -> DataFrame:
    s = gold_summary(gold_orders(spark, sf), tier="High", page_size=20)
    return s.select(*[c for c in s.columns if c not in ("bias_rate", "avg_risk_score")],
                    _r("bias_rate"), _r("avg_risk_score"))


def q_tier_share(spark: SparkSession, sf: str) -> DataFrame:
    return tier_share(gold_orders(spark, sf)).select("intervention_tier", "n", _r("pct"))


def q_entity_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("entity_id"))
    return _gold_out(bucketed_table(gold_orders(spark, sf), "entity_id", "gold").lookup(ids))


def q_lookup_plain(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows from gold rows that are not kept in buckets."""
    ids = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("entity_id"))
    return _gold_out(entity_lookup(gold_orders(spark, sf), ids))


def q_stage_join(spark: SparkSession, sf: str) -> DataFrame:
    """Gold rows beside the features they were scored from, both in buckets of the entity's id."""
    gold = bucketed_table(gold_orders(spark, sf), "entity_id", "gold")
    features = order_features(spark, sf).withColumn("entity_id", F.col("o_orderkey").cast("string"))
    joined = gold.join(bucketed_table(features, "entity_id", "features"))
    return joined.select("entity_id", "risk_score", "intervention_tier", _r("o_totalprice"), "n_lines", _r("sum_qty"))


def q_entity_index(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey")
    idx = row_index(o, ["o_orderkey"], name="row_idx")
    return idx.select("o_orderkey", "row_idx",
                      entity_id(None, "ENT", F.col("row_idx")).alias("entity_id"))


# --------------------------------------------------------------------------- profile

def q_profile_orders(spark: SparkSession, sf: str) -> DataFrame:
    p = profile_columns(table(spark, sf, "orders"))
    return p.select("column", "position", "dtype", "total_count", "null_count", _r("null_pct"),
                    "cardinality", _r("unique_ratio"), "is_likely_id", "is_binary",
                    "is_low_cardinality", "is_numeric", _r("min"), _r("max"), _r("mean"),
                    _r("median"), _r("std"),
                    F.array_join("sample_values", "|").alias("sample_values"))


def q_validate_orders(spark: SparkSession, sf: str) -> DataFrame:
    v = validate(table(spark, sf, "orders"))
    return v.select("total_rows", "total_columns", "total_nulls", "has_nulls", "valid",
                    F.array_join("issues", "; ").alias("issues"),
                    F.array_join(F.transform(F.array_sort(F.map_entries("null_counts")),
                                             lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))),
                                 ";").alias("null_counts"))


def q_validate_nations(spark: SparkSession, sf: str) -> DataFrame:
    """A table below the row minimum: reported as invalid, not blocked."""
    v = validate(table(spark, sf, "nation"))
    return v.select("total_rows", "total_columns", "total_nulls", "has_nulls", "valid",
                    F.array_join("issues", "; ").alias("issues"))


def q_feature_stats(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    st = feature_stats(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"])
    return st.select("feature", _r("min"), _r("max"), _r("mean"), _r("median"), _r("std"))


# --------------------------------------------------------------------------- silver

def _class_counts(df: DataFrame, cls: str) -> DataFrame:
    return df.groupBy(cls, TARGET).agg(F.count(F.lit(1)).alias("n"))


def q_binarize_minority(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = prepare_target(table(spark, sf, "lineitem").select("l_linestatus"), "l_linestatus")
    return _class_counts(df, "l_linestatus")


def q_binarize_multi(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = prepare_target(table(spark, sf, "orders").select("o_orderstatus"), "o_orderstatus")
    return _class_counts(df, "o_orderstatus")


def q_binarize_explicit(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = prepare_target(table(spark, sf, "orders").select("o_orderpriority"), "o_orderpriority",
                           positive_class="1-URGENT")
    return _class_counts(df, "o_orderpriority")


def q_binarize_median(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = prepare_target(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                           "o_totalprice")
    return df.select("o_orderkey", TARGET)


def q_binarize_two_valued(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = prepare_target(table(spark, sf, "labels").select("quality"), "quality")
    return _class_counts(df, "quality")


def q_binarize_coerce(spark: SparkSession, sf: str) -> DataFrame:
    """More than five text classes: numeric coercion, then above the median."""
    p = table(spark, sf, "part").select(
        "p_partkey", "p_name", F.col("p_size").cast("string").alias("p_size_text"))
    names, _ = prepare_target(p.select("p_partkey", "p_name"), "p_name")
    sizes, _ = prepare_target(p.select("p_partkey", "p_size_text"), "p_size_text")
    return names.select("p_partkey", F.col(TARGET).alias("name_binary")).join(
        sizes.select("p_partkey", F.col(TARGET).alias("size_binary")), "p_partkey")


def orders_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """orders with nulls and NaN placed by key (every row is kept)."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey",
                    F.when(k % 3 != 0, F.col("o_custkey")).alias("o_custkey"),
                    F.when(k % 13 == 0, F.lit(float("nan"))).when(k % 4 != 0, F.col("o_totalprice") / 2)
                    .alias("half_price"),
                    F.when(k % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
                    F.when(k % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
                    F.when(k % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))


def q_impute_median_mode(spark: SparkSession, sf: str) -> DataFrame:
    out, _ = impute(ingest(spark, orders_with_gaps(spark, sf)))
    return out.select("o_orderkey", _r("o_totalprice"), _r("o_custkey"), _r("half_price"),
                      "o_orderstatus", "o_orderpriority")


def q_text_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Most frequent value of text columns: of few values, of nearly unique ones, and with a tie."""
    o = table(spark, sf, "orders").select(
        "o_orderpriority", F.when(F.col("o_orderkey") % 20 < 3, F.lit("none")).otherwise(
            F.concat_ws(" ", "o_orderkey", "o_custkey")).alias("note"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("b")).otherwise(F.lit("a")).alias("side"),
        F.concat(F.lit("#"), "o_orderkey").alias("name"))
    modes = column_modes(o, o.columns)
    return spark.createDataFrame(list(modes.items()), "column string, mode string")


def user_activity(spark: SparkSession, sf: str) -> DataFrame:
    """events pivoted to one row per user (one shuffle, partially aggregated)."""
    e = table(spark, sf, "events")
    first = F.dayofmonth("ts") <= 15
    return e.groupBy("user_id").agg(
        F.count_if(first).alias("events_1"), F.count_if(~first).alias("events_2"),
        F.sum(F.when(first, F.col("value")).otherwise(0.0)).alias("value_1"),
        F.sum(F.when(~first, F.col("value")).otherwise(0.0)).alias("value_2"),
        F.count_if(F.col("event_type") == "click").alias("checkout_started"),
        F.count_if(F.col("event_type") == "purchase").alias("checkout_completed"),
        (F.count_if(F.col("event_type") == "error") >= 14).cast("int").alias("many_errors"),
        (F.count_if(F.col("event_type") == "purchase") >= 14).cast("int").alias("frequent_buyer"),
        (F.max("value") >= 250).cast("int").alias("big_ticket"))


def q_delta_ratio_flags(spark: SparkSession, sf: str) -> DataFrame:
    u = user_activity(spark, sf)
    plan = plan_features(u, exclude=["user_id"])
    out = engineer_features(u, plan)
    return out.select("user_id", F.col("delta_events").cast("long").alias("delta_events"),
                      _r("delta_value"), _r("ratio_checkout"),
                      F.col("binary_flag_sum").cast("long").alias("binary_flag_sum"))


def q_ordinal_codes(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    out, _ = encode(p, exclude=["p_partkey"])
    return out.select("p_partkey", F.col("p_name").alias("p_name_code"),
                      F.col("p_brand").alias("p_brand_code"), F.col("p_type").alias("p_type_code"))


def q_ordinal_codes_split(spark: SparkSession, sf: str) -> DataFrame:
    """Codes by the split join: a near-unique column, one with half its rows null, and one of few values."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("label"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("customer "), F.col("o_custkey").cast("string")))
        .alias("buyer"), F.col("o_orderpriority").alias("priority"))
    cols = ["label", "buyer", "priority"]
    folder = f"{checkpoint_dir(spark)}/code-tables-{uuid.uuid4().hex}"
    out = split_codes(o, parquet_handover(code_tables(o, cols), folder, "codes"), cols)
    return out.select("o_orderkey", *[F.col(c).alias(f"{c}_code") for c in cols])


# --------------------------------------------------------------------------- discovery

DISCOVERY_TABLES = TABLES


def _discovered(spark: SparkSession, sf: str, match: str = "reference"):
    return discover({t: table(spark, sf, t) for t in DISCOVERY_TABLES}, match=match)


def _classified_out(c: DataFrame) -> DataFrame:
    return c.select("table", "column", "position", "class", "sensitive_type", "feature_group",
                    "is_target", "is_identifier", "is_sensitive", "confidence", "method", "ambiguous")


def q_discover_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _classified_out(_discovered(spark, sf)[0])


def q_discover_columns_token(spark: SparkSession, sf: str) -> DataFrame:
    return _classified_out(_discovered(spark, sf, match="token")[0])


def q_schema_pick(spark: SparkSession, sf: str) -> DataFrame:
    _, picks, _ = _discovered(spark, sf)
    return picks.select("table", "target_column", "id_column", "entity_prefix",
                        F.array_join("sensitive_columns", "|").alias("sensitive_columns"),
                        F.array_join(F.transform("sensitive_attributes", lambda s: s["type"]), "|")
                         .alias("sensitive_types"),
                        F.col("total_sensitive").cast("long").alias("total_sensitive"),
                        F.col("total_columns").cast("long").alias("total_columns"))


def q_schema_summary(spark: SparkSession, sf: str) -> DataFrame:
    _, _, groups = _discovered(spark, sf)
    return groups.select("table", "feature_group", F.array_join("columns", "|").alias("columns"),
                         F.col("n_columns").cast("long").alias("n_columns"))


# --------------------------------------------------------------------------- evaluation

# A second literal scorer for the model-comparison queries.
DOCUMENT_SCORE_B = (-0.3, {"quality": 0.8, "n_chars": -0.0003})
# A literal sigmoid for the calibration query.
PLATT_AB = (1.7, -0.35)


def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    d = labelled_documents(spark, sf)
    a, b = DOCUMENT_SCORE_B
    return d.withColumn("score_b", linear_score(a, b)).withColumn(
        "pred_b", decide(F.col("score_b")))


def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return confusion(scored_documents(spark, sf), "toxic", "pred")


def q_classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = classification_metrics(scored_documents(spark, sf), "toxic", "pred")
    return m.select("tn", "fp", "fn", "tp", _r("accuracy"), _r("precision"), _r("recall"), _r("f1"))


def _model_aucs(spark: SparkSession, sf: str) -> DataFrame:
    d = scored_documents(spark, sf)
    return metrics_table({"logistic_regression": roc_auc(d, "toxic", "score"),
                          "gbt": roc_auc(d, "toxic", "score_b")})


def q_auc_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _model_aucs(spark, sf).select("model", _r("auc"))


def q_best_model(spark: SparkSession, sf: str) -> DataFrame:
    return best_model(_model_aucs(spark, sf)).select("best_model", _r("best_auc"))


def q_brier_stats(spark: SparkSession, sf: str) -> DataFrame:
    d = scored_documents(spark, sf)
    t = metrics_table({"logistic_regression": score_stats(d, "score", "toxic"),
                       "gbt": score_stats(d, "score_b", "toxic")})
    base = t.where(F.col("model") == "logistic_regression").select(F.col("brier").alias("_b0"))
    return t.crossJoin(base).select(   # base is one row
        "model", _r("brier"), _r("mean"), _r("std"), _r("min"), _r("max"), _r("median"),
        F.round(improvement_pct(F.col("_b0"), F.col("brier")), 6).alias("improvement_pct"))


def q_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    w = class_weights(scored_documents(spark, sf), "toxic")
    return w.select("label", "n", _r("balanced_weight"), _r("scale_pos_weight"))


def q_platt_apply(spark: SparkSession, sf: str) -> DataFrame:
    a, b = PLATT_AB
    d = scored_documents(spark, sf)
    cal = d.withColumn("calibrated", platt(F.col("score"), a, b))
    st = score_stats(cal, "calibrated", "toxic")
    return st.select(_r("brier"), _r("mean"), _r("std"), _r("min"), _r("max"), _r("median"))


# --------------------------------------------------------------------------- mitigation

def scored_lineitem_full(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    a, b = LINEITEM_SCORE
    return li.select("l_returnflag", "l_linestatus", linear_score(a, b).alias("score"),
                     decide(linear_score(a, b)).alias("pred"),
                     F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("y"))


def q_reweigh(spark: SparkSession, sf: str) -> DataFrame:
    w = reweighing_weights(scored_lineitem_full(spark, sf), "l_returnflag", "y")
    return w.select("grp", "label", "n", _r("weight"))


def q_group_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    df = scored_lineitem_full(spark, sf)
    th = group_thresholds(df, "l_returnflag", "score", pred="pred")
    adj = apply_thresholds(df, "l_returnflag", "score", th)
    rates = adj.groupBy(F.col("l_returnflag").alias("grp")).agg(
        F.avg(F.col("pred_adjusted").cast("double")).alias("adjusted_rate"),
        F.avg(F.col("pred").cast("double")).alias("original_rate"))
    return th.join(rates, "grp").select("grp", _r("threshold"), _r("adjusted_rate"), _r("original_rate"))


# --------------------------------------------------------------------------- scenarios

def q_scenario_baseline(spark: SparkSession, sf: str) -> DataFrame:
    b = baseline(table(spark, sf, "lineitem"), list(LINEITEM_MODEL[1]))
    return b.select("feature", _r("min"), _r("max"), _r("baseline"))


def q_scenario_grid(spark: SparkSession, sf: str) -> DataFrame:
    a, coefs = LINEITEM_MODEL
    g = grid(table(spark, sf, "lineitem"), list(coefs))
    return g.select("feature", F.col("step").cast("long").alias("step"), _r("value"),
                    F.round(linear_score(a, coefs), R6).alias("prob"))


def q_score_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    """Order feature vectors without the tax feature: it defaults to 0."""
    a, coefs = ORDER_MODEL
    sc = order_features(spark, sf).drop("avg_tax")
    out = score_scenarios(sc, a, coefs, k=5)
    return out.select("o_orderkey", _r("prob"), "prediction", "intervention_tier",
                      F.array_join(factor_names(F.col("factors")), "|").alias("top_factors"))


# --------------------------------------------------------------------------- models (rows only)

MODEL_FEATURES = ["n_chars", "quality"]
N_TREES = 200


def _doc_model_frame(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf).select("doc_id", "lang", "source", *MODEL_FEATURES, "toxic")


def q_split_md5(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_split(o, "o_orderstatus", ["o_orderkey"], kind="md5").select(
        "o_orderkey", "o_orderstatus", "is_test")


def q_fit_score_lr(spark: SparkSession, sf: str) -> DataFrame:
    d = _doc_model_frame(spark, sf)
    m = fit(d, MODEL_FEATURES, "toxic", kind="logistic_regression")
    s = m.score(d)
    return s.select("doc_id", "prob", decide(F.col("prob")).alias("prediction"),
                    intervention_tier(F.col("prob")).alias("intervention_tier"))


def q_fit_score_gbt(spark: SparkSession, sf: str) -> DataFrame:
    d = _doc_model_frame(spark, sf)
    m = fit(d, MODEL_FEATURES, "toxic", kind="gbt", n_trees=N_TREES)
    s = m.score(d)
    return s.select("doc_id", "prob", "margin", decide(F.col("prob")).alias("prediction"))


def q_calibrate_cv(spark: SparkSession, sf: str) -> DataFrame:
    d = _doc_model_frame(spark, sf)
    cal = calibrate_cv(d, MODEL_FEATURES, "toxic", ["doc_id"], kind="gbt", n_folds=5, n_trees=N_TREES)
    return cal.score(d).select("doc_id", "calibrated")


def q_tree_shap(spark: SparkSession, sf: str) -> DataFrame:
    d = _doc_model_frame(spark, sf)
    m = fit(d, MODEL_FEATURES, "toxic", kind="gbt", n_trees=N_TREES)
    shap = tree_shap(d.repartition(2 * default_parallelism(spark)), m.model, MODEL_FEATURES, ["doc_id"])
    top = top_factors(F.col("phi"), MODEL_FEATURES, 3)
    return shap.select("doc_id", "base_value", "margin",
                       F.array_join(factor_names(top), "|").alias("top_factors"))


def q_model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark, "comparison")
    # both fits, their scores and all metrics read these rows: join and split once
    d = parquet_handover(stratified_split(_doc_model_frame(spark, sf), "toxic", ["doc_id"]), folder, "split")
    train, test = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    kinds = ("logistic_regression", "gbt")
    fitted = in_parallel(lambda kind: fit(train, MODEL_FEATURES, "toxic", kind=kind,
                                          n_trees=N_TREES), kinds)
    tested = {kind: parquet_handover(m.score(test).select("toxic", "prob"), folder, f"test-{kind}")
              for kind, m in zip(kinds, fitted)}
    table_ = metrics_table({kind: evaluate(rows, "toxic", "prob") for kind, rows in tested.items()})
    return table_.crossJoin(best_model(table_)).select(   # best_model is one row
        "model", "auc", "accuracy", "precision", "recall", "f1", "tn", "fp", "fn", "tp", "best_model")


def q_fit_score_rf(spark: SparkSession, sf: str) -> DataFrame:
    """Every labelled document scored by a forest: its probability is the vote of the trees read back, and
    decision and tier agree with it."""
    d = _doc_model_frame(spark, sf)
    m = fit(d, MODEL_FEATURES, "toxic", kind="random_forest", n_trees=N_TREES)
    trees, _ = extract_trees(spark, m.model.stages[-1])

    def vote(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(tree_sum(trees, rows.to_numpy(dtype=float)))

    votes = F.pandas_udf(vote, "double")(F.struct(*[F.col(f).cast("double").alias(f) for f in MODEL_FEATURES]))
    s = m.score(d).withColumn("tier", intervention_tier(F.col("prob"))).withColumn("vote", votes)
    p = F.col("prob")
    return s.select("doc_id", (F.abs(p - F.col("vote")) < 1e-9).alias("vote_ok"), p.between(0.0, 1.0).alias("in_range"),
                    (decide(p) == F.when(p >= 0.5, 1).otherwise(0)).alias("decision_ok"),
                    (F.col("tier") == F.when(p > 0.7, "High").when(p >= 0.4, "Medium").otherwise("Low"))
                    .alias("tier_ok"))


BOOST_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def q_boost_first_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Splits, gains, covers and leaf values of the first boosted tree (depth 2) on lineitem."""
    d = table(spark, sf, "lineitem").select(*BOOST_FEATURES, (F.col("l_returnflag") == "R").cast("int").alias("y"))
    tree = fit(d, BOOST_FEATURES, "y", kind="gbt", n_trees=1, max_depth=2)
    rows = [(n["node"], BOOST_FEATURES[n["split"]] if n["split"] >= 0 else None,
             n["threshold"] if n["split"] >= 0 else None, n["gain"], n["cover"], n["value"]) for n in tree.nodes()]
    out = spark.createDataFrame(rows, "node int, feature string, threshold double, gain double, cover double, value double")
    return out.select("node", "feature", "threshold", F.round("gain", 3).alias("gain"),
                      F.round("cover", 3).alias("cover"), _r("value"))


def q_boost_loss(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees per document: probability and margin agree, and the weighted loss fell below that of margin 0."""
    d = with_weights(_doc_model_frame(spark, sf), "toxic", "scale_pos")
    m = fit(d.drop("weight"), MODEL_FEATURES, "toxic", kind="gbt", n_trees=N_TREES)
    s = m.score(d)
    y = F.col("toxic")
    loss = F.log1p(F.exp(-F.abs("margin"))) + F.greatest("margin", F.lit(0.0)) - y * F.col("margin")
    same = F.abs(F.col("prob") - 1 / (1 + F.exp(-F.col("margin")))) < 1e-12
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(same).alias("prob_ok"),
                 (F.sum(F.col("weight") * loss) < F.lit(math.log(2)) * F.sum("weight")).alias("loss_fell"))


def q_calibrated_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: the calibrated probability is the mean of the five folds' sigmoids of their margins."""
    d = _doc_model_frame(spark, sf)
    cal = calibrate_cv(d, MODEL_FEATURES, "toxic", ["doc_id"], kind="gbt", n_folds=5, n_trees=20)
    each = [base.score(d, prob="_p", margin="m").select("doc_id", (1 / (1 + F.exp(-(a * F.col("m") + b)))).alias("p"))
            for base, a, b in cal.folds]
    mean = reduce(DataFrame.unionAll, each).groupBy("doc_id").agg(F.avg("p").alias("mean"), F.count("p").alias("folds"))
    return cal.score(d).join(mean, "doc_id").select(
        "doc_id", "folds", (F.abs(F.col("calibrated") - F.col("mean")) < 1e-9).alias("mean_ok"))


def q_tree_shap_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: base value and attributions add up to the model's own margin."""
    d = _doc_model_frame(spark, sf)
    m = fit(d, MODEL_FEATURES, "toxic", kind="gbt", n_trees=N_TREES)
    shap = tree_shap(m.score(d).withColumnRenamed("margin", "own"), m.model, MODEL_FEATURES, ["doc_id", "own"])
    total = F.col("base_value") + F.aggregate("phi", F.lit(0.0), lambda a, v: a + v)
    return shap.select("doc_id", (F.abs(total - F.col("own")) < 1e-8).alias("sum_ok"))


def q_lr_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted regression is the optimum: its penalised, weighted gradient is near zero in every coordinate."""
    d = _doc_model_frame(spark, sf).withColumn("n_chars", F.col("n_chars") / 1000)
    m = fit(d, MODEL_FEATURES, "toxic", kind="logistic_regression")
    lr = m.model.stages[-1]
    scored = with_weights(m.score(d), "toxic", "balanced")
    gap = F.col("weight") * (F.col("prob") - F.col("toxic"))
    total = F.sum("weight")
    parts = [((F.sum(gap * F.col(f)) + F.lit(float(b))) / total).alias(f)
             for f, b in zip(MODEL_FEATURES, lr.coefficients)]
    row = scored.agg(*parts, (F.sum(gap) / total).alias("intercept"), F.count(F.lit(1)).alias("n_rows"))
    return row.select("n_rows", *[(F.abs(c) < 1e-5).alias(f"{c}_zero") for c in (*MODEL_FEATURES, "intercept")])


# --------------------------------------------------------------------------- sources and sinks

def _scratch(spark: SparkSession) -> str:
    return scratch_folder(spark, "io")


def q_ingest_csv(spark: SparkSession, sf: str) -> DataFrame:
    """orders written as CSV and ingested by path, with inferred types."""
    path = f"{_scratch(spark)}/orders.csv"
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.option(
        "header", True).csv(path)
    back = ingest(spark, path)
    return back.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), _r("o_totalprice"), "o_orderstatus",
                       F.lit(dict(back.dtypes)["o_totalprice"]).alias("price_type"))


def q_cached_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """customer through the read-through cache: the second read finds the copy and needs no source."""
    folder = _scratch(spark)
    cached_dataset(spark, "customer", folder, table(spark, sf, "customer"))
    return cached_dataset(spark, "customer", folder).select("c_custkey", "c_name", _r("c_acctbal"))


def _published(spark: SparkSession, sf: str, folder: str) -> Versions:
    """Two commits of one run's sinks, the second of which breaks half way; the first must be what is read."""
    df, feats = attributed_lineitem(spark, sf)
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    out = publish(spark, folder, "run-1", c, ["c_mktsegment"], gold_orders(spark, sf).limit(0),
                  global_importance(df, feats))
    try:
        out.commit("run-2", {"silver": lambda p: write_silver(c.limit(1), ["c_mktsegment"], p), "gold": _refuse})
    except RuntimeError:
        pass
    return out


def _refuse(path: str) -> None:
    raise RuntimeError(f"no write to {path}")


def q_silver_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Silver features as read back from the version that was committed last."""
    out = _published(spark, sf, f"{_scratch(spark)}/sinks")
    back = spark.read.parquet(f"{out.folder('silver')}/features")
    apart = spark.read.parquet(f"{out.folder('silver')}/sensitive_attributes").groupBy("c_mktsegment").count()
    return back.join(apart, "c_mktsegment").select("c_custkey", _r("c_acctbal"), "c_mktsegment",
                                                   F.col("count").alias("n_segment"))


def q_importance_sink(spark: SparkSession, sf: str) -> DataFrame:
    out = _published(spark, sf, f"{_scratch(spark)}/sinks")
    schema = "feature string, importance double, relative double, rank long"
    return spark.read.schema(schema).json(out.folder("importance")).select(
        "feature", _r("importance"), _r("relative"), "rank")


def q_metrics_log(spark: SparkSession, sf: str) -> DataFrame:
    """A run's confusion counts, logged twice: one set of rows."""
    path = f"{_scratch(spark)}/metrics"
    row = q_confusion(spark, sf).first().asDict()
    for _ in range(2):
        replace_metrics(metrics_rows(spark, "run-1", "confusion", row), path)
    return read_metrics(spark, path).select("run_id", "stage", "key", "value")


def q_preview(spark: SparkSession, sf: str) -> DataFrame:
    """Column types of orders beside the number of rows of the table and of its preview."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    dtypes, first = preview(o, 5)
    kinds = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(dtypes)], "position int, column string, dtype string")
    sizes = o.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(first.agg(F.count(F.lit(1)).alias("n_preview")))
    return kinds.crossJoin(sizes)             # one row of sizes


def q_gold_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """The gold table of orders through its three sinks: rows and summed scores of each, read back."""
    folder = _scratch(spark)
    write_gold(gold_orders(spark, sf), folder)
    read = {"parquet": spark.read.parquet(f"{folder}/parquet"), "json": spark.read.json(f"{folder}/json"),
            "csv": spark.read.option("header", True).csv(f"{folder}/csv")}
    out = None
    for fmt, df in read.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("entity_id").alias("n_entities"),
                     F.round(F.sum(F.col("risk_score").cast("double")), 3).alias("total_score"),
                     F.min(F.lit(",".join(sorted(df.columns)))).alias("columns")).select(F.lit(fmt).alias("sink"), "*")
        out = one if out is None else out.union(one)
    return out


# --------------------------------------------------------------------------- streaming

def _event_parts():
    attrs = [("event_type", F.col("event_type"))]
    pred = F.when(F.col("value") >= 35, 1).otherwise(0)
    label = F.when(F.get_json_object("props", "$.k").cast("int") >= 50, 1).otherwise(0)
    return attrs, pred, label


def _window_out(df: DataFrame) -> DataFrame:
    return df.select(F.col("window_start").cast("long").alias("window_start"), "attribute",
                     F.col("n_groups").cast("long").alias("n_groups"),
                     F.col("n_rows").cast("long").alias("n_rows"), _r("dpd"), _r("eod"),
                     "dpd_flagged", "eod_flagged")


def q_bias_by_window(spark: SparkSession, sf: str) -> DataFrame:
    attrs, pred, label = _event_parts()
    return _window_out(bias_by_window(table(spark, sf, "events"), "ts", attrs, pred, label, "1 day"))


def q_stream_bias_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """The same monitor as a Structured Streaming query (file source, availableNow);
    the last window is still open at the end of the input and is not emitted."""
    attrs, pred, label = _event_parts()
    schema = table(spark, sf, "events").schema
    out = run_monitor(spark, sf.rstrip("/"), schema, "ts", attrs, pred, label, window="1 day",
                      watermark="1 hour", file_glob="events.parquet",
                      out_dir=f"{shared_root(spark)}/bias-monitor-{uuid.uuid4().hex}")
    return _window_out(out)


def _value_out(df: DataFrame) -> DataFrame:
    return df.select("window_start", "attribute", "n_groups", "n_rows", _r("dpd"), _r("eod"), "dpd_flagged",
                     "eod_flagged")


def _value_parts():
    _, _, label = _event_parts()
    return [("value", F.col("value"))], F.when(F.col("event_type").isin("click", "purchase"), 1).otherwise(0), label


def q_bias_by_value_window(spark: SparkSession, sf: str) -> DataFrame:
    attrs, pred, label = _value_parts()
    return _value_out(bias_by_value_window(table(spark, sf, "events"), "ts", attrs, pred, label))


def q_stream_value_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a stream with state per attribute; the idle timer closes the last window."""
    attrs, pred, label = _value_parts()
    return _value_out(run_value_monitor(
        spark, sf.rstrip("/"), table(spark, sf, "events").schema, "ts", attrs, pred, label, file_glob="events.parquet",
        out_dir=f"{shared_root(spark)}/value-monitor-{uuid.uuid4().hex}"))


# --------------------------------------------------------------------------- end to end (rows only)

def q_run_documents(spark: SparkSession, sf: str) -> DataFrame:
    from .run import run
    src = labelled_documents(spark, sf).select("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    res = run(spark, src, target="toxic", sensitive=[("lang", "language"), ("source", "origin")],
              n_trees=N_TREES, n_folds=5)
    return _gold_out(res.gold)


def q_run_gold_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One gold row per entity of a run, with the tier of its score and as many factors as features, up to three."""
    from .run import run
    src = labelled_documents(spark, sf).select("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    res = run(spark, src, target="toxic", id_column="doc_id", sensitive=[("lang", "language")], n_trees=20, n_folds=5)
    score, tier = F.col("risk_score"), F.col("intervention_tier")
    fits = (((tier == "High") & (score >= 0.7)) | ((tier == "Medium") & score.between(0.4, 0.7))
            | ((tier == "Low") & (score <= 0.4)))
    n = len(res.features)
    return res.gold.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(fits).alias("tier_ok"),
        F.bool_and(F.size("top_factors") == min(3, n)).alias("factors_ok"))


def q_run_orders(spark: SparkSession, sf: str) -> DataFrame:
    from .run import run
    src = order_features(spark, sf)
    res = run(spark, src, target="o_orderstatus", positive_class="F", id_column="o_orderkey",
              sensitive=[("o_orderpriority", "priority")], n_trees=N_TREES, n_folds=5)
    return _gold_out(res.gold)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "run_documents": q_run_documents,
    "run_orders": q_run_orders,
    "bias_by_window": q_bias_by_window,
    "stream_bias_monitor": q_stream_bias_monitor,
    "bias_by_value_window": q_bias_by_value_window,
    "stream_value_monitor": q_stream_value_monitor,
    "scenario_baseline": q_scenario_baseline,
    "scenario_grid": q_scenario_grid,
    "score_scenarios": q_score_scenarios,
    "split_md5": q_split_md5,
    "fit_score_lr": q_fit_score_lr,
    "fit_score_gbt": q_fit_score_gbt,
    "calibrate_cv": q_calibrate_cv,
    "tree_shap": q_tree_shap,
    "model_comparison": q_model_comparison,
    "fit_score_rf": q_fit_score_rf,
    "boost_first_tree": q_boost_first_tree,
    "boost_loss": q_boost_loss,
    "calibrated_mean": q_calibrated_mean,
    "tree_shap_sums": q_tree_shap_sums,
    "run_gold_rows": q_run_gold_rows,
    "lr_optimum": q_lr_optimum,
    "ingest_csv": q_ingest_csv,
    "cached_dataset": q_cached_dataset,
    "gold_sinks": q_gold_sinks,
    "silver_sink": q_silver_sink,
    "importance_sink": q_importance_sink,
    "metrics_log": q_metrics_log,
    "preview": q_preview,
    "confusion": q_confusion,
    "classification_metrics": q_classification_metrics,
    "auc_exact": q_auc_exact,
    "best_model": q_best_model,
    "brier_stats": q_brier_stats,
    "class_weights": q_class_weights,
    "platt_apply": q_platt_apply,
    "reweigh": q_reweigh,
    "group_thresholds": q_group_thresholds,
    "discover_columns": q_discover_columns,
    "discover_columns_token": q_discover_columns_token,
    "schema_pick": q_schema_pick,
    "schema_summary": q_schema_summary,
    "binarize_minority": q_binarize_minority,
    "binarize_multi": q_binarize_multi,
    "binarize_explicit": q_binarize_explicit,
    "binarize_median": q_binarize_median,
    "binarize_two_valued": q_binarize_two_valued,
    "binarize_coerce": q_binarize_coerce,
    "impute_median_mode": q_impute_median_mode,
    "text_modes": q_text_modes,
    "delta_ratio_flags": q_delta_ratio_flags,
    "ordinal_codes": q_ordinal_codes,
    "ordinal_codes_split": q_ordinal_codes_split,
    "profile_orders": q_profile_orders,
    "validate_orders": q_validate_orders,
    "validate_nations": q_validate_nations,
    "feature_stats": q_feature_stats,
    "linear_attribution": q_linear_attribution,
    "top_factors": q_top_factors,
    "global_importance": q_global_importance,
    "factor_strength": q_factor_strength,
    "reason_text": q_reason_text,
    "reason_text_short": q_reason_text_short,
    "display_names": q_display_names,
    "gold_table": q_gold_table,
    "gold_flagged": q_gold_flagged,
    "gold_page": q_gold_page,
    "gold_pages": q_gold_pages,
    "gold_summary": q_gold_summary,
    "gold_summary_filtered": q_gold_summary_filtered,
    "tier_share": q_tier_share,
    "entity_lookup": q_entity_lookup,
    "lookup_plain": q_lookup_plain,
    "stage_join": q_stage_join,
    "entity_index": q_entity_index,
    "audit_lineitem": audit_lineitem,
    "audit_groups": audit_groups,
    "audit_report": audit_report,
    "audit_summary": audit_summary,
    "audit_documents": audit_documents,
    "audit_customer": audit_customer,
    "audit_text": audit_text,
    "entity_bias_flag": entity_bias_flag,
}
