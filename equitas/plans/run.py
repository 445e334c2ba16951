"""End-to-end run: any table in, one audited gold row per entity out.

ingest -> validate -> discover -> silver -> split -> fit -> pick best ->
calibrate -> score every row -> fairness audit -> attributions -> reasons ->
gold. Everything is a lazy DataFrame except the fits and the small collected
statistics that decide the plan. What several later steps read is handed over
as Parquet in the shared folder: the silver frame, the split, the held-out
scores, the scored rows and the attributed rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import decide
from ..operators.attribution import global_importance, linear_attribution, top_factors
from ..operators.audit import AuditResult, fairness_audit
from ..operators.discovery import discover
from ..operators.evaluate import best_model, evaluate, improvement_pct, metrics_table, score_stats
from ..operators.gold import build_gold, explain_entities, gold_summary
from ..operators.models import Calibrated, Fitted, calibrate_cv, fit, fit_with_folds, in_parallel, stratified_split
from ..operators.scenarios import score_fitted
from ..operators.silver import TARGET, Silver, model_feature_columns, transform
from ..operators.treeshap import tree_shap
from ..session import default_parallelism, parquet_handover, remove, shared_root
from ..sources.ingest import (audit_metrics, ingest, log_metrics, metrics_rows, validate, write_gold,
                              write_importance, write_silver)

ROW_KEY = "_row_key"
RAW = "__raw__"


@dataclass
class Result:
    validation: DataFrame
    columns: DataFrame
    schema: dict
    silver: Silver
    features: list
    metrics: DataFrame
    best: str
    scored: DataFrame
    audit: AuditResult
    gold: DataFrame
    summary: DataFrame
    importance: DataFrame
    calibration: DataFrame | None = None    # Brier and distribution before and after, on the test rows
    calibrated: Calibrated | None = None
    models: dict = field(default_factory=dict)
    folder: str = ""

    def explain(self, ids: DataFrame) -> DataFrame:
        """Signed factors of the entities in ``ids``."""
        return explain_entities(self.scored, ids, self.schema["id_column"] or ROW_KEY)

    def score_scenarios(self, scenarios: DataFrame, k: int = 5) -> DataFrame:
        """Feature vectors through the best model, as the run scored its rows."""
        plain = plain_names(self.features)
        given = scenarios.select("*", *[F.col(f"`{f}`").alias(x) for f, x in zip(self.features, plain)
                                        if x != f and f in scenarios.columns])
        return score_fitted(given, self.models[self.best], plain, self.calibrated, k, names=self.features).drop(
            *[x for f, x in zip(self.features, plain) if x != f])

    def close(self) -> None:
        """Remove the hand-over tables; the lazy frames of the result cannot be read after that."""
        remove(self.gold.sparkSession, self.folder)


def plain_names(features: list) -> list:
    """The features' names, without dots and backticks, which models cannot take; still all different."""
    out: list = []
    for f in features:
        name = f.replace(".", "_").replace("`", "_")
        while name != f and (name in features or name in out):
            name += "_"
        out.append(name)
    return out


def calibration_report(test: DataFrame, label: str, before: str, after: str) -> DataFrame:
    """One row: Brier score, mean, std, min, max and median before and after, and the improvement in percent."""
    names = ("mean", "std", "min", "max", "median", "brier")
    b, a = (score_stats(test, c, label).select(*[F.col(n).alias(f"{n}_{when}") for n in names])
            for c, when in ((before, "before"), (after, "after")))
    return b.crossJoin(a).withColumn(        # two one-row frames
        "improvement_pct", improvement_pct(F.col("brier_before"), F.col("brier_after")))


def run(spark: SparkSession, source, *, target: str | None = None, positive_class=None,
        sensitive: list | None = None, id_column: str | None = None, entity_prefix: str | None = None,
        match: str = "reference", kinds=("logistic_regression", "gbt"), n_trees: int = 200,
        max_depth: int | None = None, n_folds: int = 5, calibrate: bool = True,
        use_encoded: bool = False, flag_scope: str = "attribute", top_k: int = 3,
        audit_split: str = "all", drop_null_target: bool = False, out_dir: str | None = None) -> Result:
    """Run all steps over ``source``; see the module's doc.

    ``audit_split="test"`` audits the held-out rows only. With ``out_dir`` the
    silver, gold and importance tables, the calibrated model and the metrics
    log are written there. ``id_column=""`` says that no column identifies rows;
    equal rows then share their split and fold, and each is scored.
    """
    folder = f"{shared_root(spark)}/equitas-run-{uuid.uuid4().hex}"
    bronze = ingest(spark, source)
    validation = validate(bronze)

    # --- schema discovery (one row of picks per table)
    classified, picks, _ = discover({"data": bronze}, match=match)
    p = picks.first()
    target = target or p["target_column"]
    id_column = (id_column if id_column is not None else p["id_column"]) or None
    if sensitive is None:
        sensitive = [(s["column"], s["type"]) for s in p["sensitive_attributes"]]
    sensitive = [(s, None) if isinstance(s, str) else tuple(s) for s in sensitive]
    sensitive = [s for s in sensitive if s[0] != target]
    prefix = entity_prefix or p["entity_prefix"]
    schema = dict(target_column=target, id_column=id_column, entity_prefix=prefix,
                  sensitive=[s[0] for s in sensitive],
                  id_source="column" if id_column else "generated")

    # --- silver, cut from its lineage once
    if not id_column:
        bronze = bronze.withColumn(ROW_KEY, F.xxhash64(*[F.col(f"`{c}`") for c in bronze.columns]))
    silver = transform(bronze, target, [s[0] for s in sensitive], id_column=id_column,
                       positive_class=positive_class, with_codes=use_encoded, drop_null_target=drop_null_target)
    frame = parquet_handover(silver.frame, folder, "silver")
    named = [c for c in model_feature_columns(frame, target, id_column, silver.encoded, use_encoded)
             if not c.startswith(RAW) and c != ROW_KEY]
    feats, key_cols = plain_names(named), [ROW_KEY]
    raw = [f"{RAW}{c}" for c, _ in sensitive]
    # what the later steps read: key, target, features and the audited labels
    frame = frame.select(F.col(f"`{id_column or ROW_KEY}`").alias(ROW_KEY), TARGET,
                         *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(x) for c, x in zip(named, feats)],
                         *[F.col(f"`{c}`") for c in dict.fromkeys(raw)])

    # --- split, fit, compare on the held-out rows
    split = parquet_handover(stratified_split(frame, TARGET, key_cols), folder, "split")
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    bases: list = []                                                # fold models, fitted beside the candidate

    def candidate(kind: str):
        if kind == "gbt" and calibrate:
            whole, *folds = fit_with_folds(train, feats, TARGET, key_cols, n_folds, n_trees, max_depth)
            bases.extend(folds)
            return whole
        return fit(train, feats, TARGET, kind=kind, n_trees=n_trees, max_depth=max_depth)

    models: dict[str, Fitted] = dict(zip(kinds, in_parallel(candidate, kinds)))
    tested = {kind: parquet_handover(models[kind].score(test).select(TARGET, "prob"), folder, f"test-{kind}")
              for kind in kinds}
    metrics = metrics_table({kind: evaluate(rows, TARGET, "prob") for kind, rows in tested.items()})
    best = best_model(metrics).first()["best_model"]

    # --- probabilities for every row (training rows included, as in the reference)
    cal, report = None, None
    if calibrate:
        cal = calibrate_cv(train, feats, TARGET, key_cols, kind=best, n_folds=n_folds, n_trees=n_trees,
                           max_depth=max_depth, bases=bases if best == "gbt" else None)
        # the uncalibrated probability stays beside the other, so repeated rows are never joined
        scored = cal.score(split, name="risk_score", beside=models[best], before="before")
    else:
        scored = models[best].score(split, prob="risk_score").drop("margin")
    # the audit, the flags and the attributions all read the scores: score once
    scored = parquet_handover(scored.withColumn("prediction", decide(F.col("risk_score"))), folder, "scored")
    if cal is not None:
        report = calibration_report(scored.where("is_test"), TARGET, "before", "risk_score")

    # --- audit on the original labels of the sensitive columns
    audited = scored.where("is_test") if audit_split == "test" else scored
    audit = fairness_audit(audited.select(*[F.col(f"`{RAW}{c}`").alias(c) for c, _ in sensitive],
                                          "prediction", TARGET), sensitive, "prediction", TARGET)
    labelled = scored.select("*", *[F.col(f"`{RAW}{c}`").alias(f"__audit__{c}") for c, _ in sensitive])
    flagged = audit.entity_flags(labelled, scope=flag_scope, name="bias_flag") if sensitive else \
        scored.withColumn("bias_flag", F.lit(False))

    # --- attributions: TreeSHAP for trees (margin space), exact linear otherwise
    keep = list(dict.fromkeys([*key_cols, "risk_score", "bias_flag"]))
    if best == "logistic_regression":
        lr = models[best].model.stages[-1]
        coefs = {f: float(b) for f, b in zip(feats, lr.coefficients)}
        attributed = linear_attribution(flagged, coefs).select(*keep, "phi")
    else:
        # Python work per row: dealt out evenly, keys and features only
        narrow = flagged.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, *feats])])
        attributed = tree_shap(narrow.repartition(2 * default_parallelism(spark)), models[best].model, feats, keep)
    # gold, its summary and the global importance all read the attributions
    attributed = parquet_handover(attributed.withColumn("factors", top_factors(F.col("phi"), named, top_k)),
                                  folder, "attributed")

    gold = build_gold(attributed, "risk_score", "factors", "bias_flag", id_column=ROW_KEY if id_column else None,
                      prefix=prefix, order=key_cols)
    if id_column:
        scored, attributed = (d.withColumnRenamed(ROW_KEY, id_column) for d in (scored, attributed))
    summary = gold_summary(gold).select("*", F.lit(schema["id_source"]).alias("id_source"),
                                        F.lit(prefix).alias("entity_prefix"))
    out = Result(validation, classified, schema, silver, named, metrics, best, attributed, audit, gold,
                 summary, global_importance(attributed, named), report, cal, models, folder)
    if out_dir:
        write_outputs(out, out_dir.rstrip("/"), [s[0] for s in sensitive])
    return out


def write_outputs(result: Result, out_dir: str, sensitive: list) -> None:
    """All sinks of a run under ``out_dir``, and its metrics appended to ``out_dir/metrics``."""
    spark, run_id = result.gold.sparkSession, uuid.uuid4().hex
    frame = spark.read.parquet(f"{result.folder}/silver")
    raw = [F.col(f"`{RAW}{c}`").alias(c) for c in sensitive]
    named = frame.select(*[F.col(f"`{c}`") for c in frame.columns if not c.startswith(RAW) and c not in sensitive], *raw)
    write_silver(named, sensitive, f"{out_dir}/silver")
    write_gold(result.gold, f"{out_dir}/gold")
    write_importance(result.importance, f"{out_dir}/importance")
    result.models[result.best].save(f"{out_dir}/model")
    if result.calibrated is not None:
        result.calibrated.save(f"{out_dir}/calibrated")
    # one row per model, one row of totals each
    for r in result.metrics.collect():
        values = {k: r[k] for k in r.asDict() if k != "model"}
        log_metrics(metrics_rows(spark, run_id, f"model_{r['model']}", values), f"{out_dir}/metrics")
    singles = [("gold", result.summary.drop("id_source", "entity_prefix")), ("calibration", result.calibration)]
    for stage, one in singles:
        if one is not None:
            log_metrics(metrics_rows(spark, run_id, stage, one.first().asDict()), f"{out_dir}/metrics")
    if sensitive:
        log_metrics(audit_metrics(result.audit.report, run_id), f"{out_dir}/metrics")
