"""Fairness audit: demographic-parity and equal-opportunity differences.

Plan, for any number of sensitive attributes:

* every row is unpivoted into (attribute, value, pred, label) inside the scan
  stage and reduced by one ``groupBy(attribute, value)``; partial aggregation
  means the shuffle carries one row per value per task, however skewed the
  values are. This table is written to the shared checkpoint folder;
* numeric attributes of very many values (a HyperLogLog pass tells) stay out
  of that table: their quartiles are bracketed (:mod:`..plans.brackets`) and
  their rows are reduced to bins in the scan stage, so no table of the input's
  size is shuffled or written;
* from it, exact distinct counts decide how each attribute is grouped: float
  columns, and other columns with more than ten distinct values, are cut
  into quartile bins whose edges come from :func:`exact_quantiles` weighted
  by the value counts (one distributed job for all such attributes);
* values are mapped to groups by literal edges and re-aggregated, and a
  second, tiny ``groupBy(attribute)`` turns group rates into DPD / EOD.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binning import bin_by_edges, dedupe_edges
from ..plans.quantiles import exact_quantiles, unpivot_numeric
from ..plans.text_ranks import text_edges, text_ranks
from ..session import reliable_checkpoint

log = logging.getLogger(__name__)

# Fixed value: a difference at or above this flags a breach (not configurable).
BIAS_THRESHOLD = 0.05
# Quartile cut points and the distinct-count above which a
# non-float attribute is binned.
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
MAX_PLAIN_GROUPS = 10
# Distinct values (estimated) from which a numeric attribute is binned row by
# row instead of through the value table; the answers are the same.
NARROW_VALUES = 10_000

_FLOAT_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)


@dataclass
class AttributePlan:
    column: str
    attr_type: str | None
    mode: str                     # "plain" | "numeric_bins" | "ordinal_bins"
    edges: list = field(default_factory=list)   # numeric edges or value thresholds

    def group(self, df: DataFrame) -> tuple[Column, Column]:
        """(group label as string, numeric sort key or null)."""
        c = F.col(_q(self.column))
        dtype = df.schema[self.column].dataType
        if self.mode == "numeric_bins":
            code = bin_by_edges(c.cast("double"), self.edges)
            return code.cast("string"), code.cast("double")
        if self.mode == "ordinal_bins":
            code = bin_by_edges(c, self.edges)
            return code.cast("string"), code.cast("double")
        if isinstance(dtype, T.BooleanType):
            return F.when(c, "True").when(~c, "False"), c.cast("double")
        if isinstance(dtype, T.NumericType):
            return c.cast("string"), c.cast("double")
        return c.cast("string"), F.lit(None).cast("double")


def _q(name: str) -> str:
    return f"`{name}`" if not name.startswith("`") else name


def _normalize_sensitive(sensitive) -> list[tuple[str, str | None]]:
    out = []
    for s in sensitive:
        if isinstance(s, str):
            out.append((s, None))
        elif isinstance(s, Mapping):
            out.append((s["column"], s.get("type")))
        else:
            out.append((s[0], s[1] if len(s) > 1 else None))
    return out


def _label_exprs(df: DataFrame, column: str) -> tuple[Column, Column]:
    """(value as text, value as double or null) for one attribute."""
    c = F.col(_q(column))
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "True").when(~c, "False"), c.cast("double")
    if isinstance(dtype, T.NumericType):
        return c.cast("string"), c.cast("double")
    return c.cast("string"), F.lit(None).cast("double")


def value_table(df: DataFrame, columns: Sequence[str], pred: str, label: str) -> DataFrame:
    """One row per (attribute, distinct value) with the four audit counts.

    Every row is unpivoted inside the scan stage and reduced by one
    ``groupBy``; partial aggregation sends at most one row per value per task
    through the shuffle, however skewed the values are. Distinct counts,
    quartile edges and group rates are all computed from this table, so the
    input is scanned once.
    """
    items = []
    for c in columns:
        txt, num = _label_exprs(df, c)
        items.append(F.struct(F.lit(c).alias("attribute"), txt.alias("v_txt"), num.alias("v_num")))
    return _audit_counts(df, items, ["attribute", "v_txt", "v_num"], pred, label)


def _audit_counts(df: DataFrame, items: Sequence[Column], names: Sequence[str], pred: str,
                  label: str) -> DataFrame:
    """The four audit counts by the fields ``names`` of ``items``, unpivoted in the scan stage."""
    p_col = F.col(_q(pred)).cast("long")
    y_col = F.col(_q(label)).cast("long")
    long = df.select(F.explode(F.array(*items)).alias("_a"), p_col.alias("_p"), y_col.alias("_y"))
    return long.groupBy(*[F.col(f"_a.{c}").alias(c) for c in names]).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_p").alias("n_pred_pos"),
        F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col("_y") == 1, F.col("_p")).otherwise(0)).alias("n_true_pos"))


def wide_attributes(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Numeric and text attributes of more than about NARROW_VALUES distinct values, by one pass of sketches."""
    some = [c for c in columns if isinstance(df.schema[c].dataType, (T.NumericType, T.StringType))]
    if not some:
        return []
    seen = df.agg(*[F.approx_count_distinct(F.col(_q(c))).alias(f"d{i}") for i, c in enumerate(some)]).first()
    return [c for i, c in enumerate(some) if seen[i] > NARROW_VALUES]


def plan_attributes(df: DataFrame, sensitive, values: DataFrame | None = None,
                    pred: str | None = None, label: str | None = None,
                    wide: Sequence[str] = ()) -> list[AttributePlan]:
    """Decide plain groups vs quartile bins and compute all bin edges.

    Works on the (attribute, value) table of :func:`value_table` (built here
    from ``pred`` / ``label`` when not given): exact distinct counts are a
    count of its rows, and the quartiles are exact, weighted by the value
    counts, one small job per value kind (numeric / text) of binned attributes.
    Attributes in ``wide`` are binned, with quartiles from their own rows.
    """
    attrs = []
    for col, typ in _normalize_sensitive(sensitive):
        if col not in df.columns:
            log.warning("sensitive column %r not found, skipped", col)
            continue
        attrs.append((col, typ))
    if not attrs:
        return []
    narrow = [c for c, _ in attrs if c not in wide]
    if values is None and narrow:
        values = value_table(df, narrow, pred, label)
    counts = (values.where(F.col("v_txt").isNotNull()).groupBy("attribute").count().collect()
              if narrow else [])
    nunique = {c: 0 for c, _ in attrs} | {r["attribute"]: r["count"] for r in counts}
    plans: list[AttributePlan] = []
    for c, typ in attrs:
        dtype = df.schema[c].dataType
        if c in wide and isinstance(dtype, T.StringType):
            mode = "ordinal_bins"
        elif c in wide or isinstance(dtype, _FLOAT_TYPES):
            mode = "numeric_bins"
        elif nunique[c] > MAX_PLAIN_GROUPS:
            mode = "numeric_bins" if isinstance(dtype, T.NumericType) else "ordinal_bins"
        else:
            mode = "plain"
        plans.append(AttributePlan(c, typ, mode))

    texts = [p for p in plans if p.column in wide and p.mode == "ordinal_bins"]
    ranks = text_ranks(df, [p.column for p in texts], QUARTILES) if texts else {}
    for p in texts:
        if ranks[p.column] is not None:
            p.edges = text_edges(ranks[p.column])
        else:                                       # the sample missed a rank: count all values of the column
            q = exact_quantiles(df.select(F.lit(p.column).alias("attribute"), F.col(_q(p.column)).alias("v_txt")),
                                ["attribute"], "v_txt", QUARTILES, with_codes=True)
            p.edges = _code_thresholds(q.collect())
    many = [p for p in plans if p.column in wide and p.mode == "numeric_bins"]
    if many:
        q = exact_quantiles(unpivot_numeric(df, [p.column for p in many]), ["_attr"], "_val", QUARTILES).collect()
        for p in many:
            p.edges = dedupe_edges([r["value"] for r in sorted(q, key=lambda r: r["q_idx"]) if r["_attr"] == p.column])
    numeric = [p for p in plans if p.mode == "numeric_bins" and p.column not in wide]
    if numeric:
        rows = values.where(F.col("attribute").isin([p.column for p in numeric]))
        hint = max(nunique[p.column] for p in numeric)
        q = exact_quantiles(rows, ["attribute"], "v_num", QUARTILES, distinct_hint=hint,
                            count_col="n").collect()
        for p in numeric:
            p.edges = dedupe_edges([r["value"] for r in q if r["attribute"] == p.column])
    ordinal = [p for p in plans if p.mode == "ordinal_bins" and p.column not in wide]
    if ordinal:
        rows = values.where(F.col("attribute").isin([p.column for p in ordinal]))
        q = exact_quantiles(rows, ["attribute"], "v_txt", QUARTILES, with_codes=True,
                            count_col="n", distinct_hint=max(nunique[p.column] for p in ordinal)).collect()
        for p in ordinal:
            p.edges = _code_thresholds([r for r in q if r["attribute"] == p.column])
    return plans


def _code_thresholds(rows: Sequence) -> list[str]:
    """Text thresholds of rank-coded edges; duplicate code edges are dropped, thresholds may repeat."""
    thresholds, last = [], None
    for r in sorted(rows, key=lambda r: r["q_idx"]):
        if last is None or r["code"] != last:
            thresholds.append(r["low_value"])
            last = r["code"]
    return thresholds


def with_groups(df: DataFrame, plans: Sequence[AttributePlan]) -> DataFrame:
    """Add ``grp__<attr>`` columns (string labels) to ``df``."""
    return df.select("*", *[p.group(df)[0].alias(f"grp__{p.column}") for p in plans])


def group_stats(values: DataFrame, plans: Sequence[AttributePlan]) -> DataFrame:
    """One row per (attribute, group): n, positive predictions, positives, TPR.

    Groups are formed on the (attribute, value) table: plain attributes keep
    their values, binned ones map each value to its bin by literal edges.
    """
    grp, order = None, None
    for p in plans:
        is_p = F.col("attribute") == F.lit(p.column)
        if p.mode == "numeric_bins":
            code = bin_by_edges(F.col("v_num"), p.edges)
            g, o = code.cast("string"), code.cast("double")
        elif p.mode == "ordinal_bins":
            code = bin_by_edges(F.col("v_txt"), p.edges)
            g, o = code.cast("string"), code.cast("double")
        else:
            g, o = F.col("v_txt"), F.col("v_num")
        grp = F.when(is_p, g) if grp is None else grp.when(is_p, g)
        order = F.when(is_p, o) if order is None else order.when(is_p, o)
    return _rates(values.groupBy("attribute", grp.alias("grp"), order.alias("grp_ord")).agg(
        *[F.sum(c).alias(c) for c in ("n", "n_pred_pos", "n_pos", "n_true_pos")]))


def bin_stats(df: DataFrame, plans: Sequence[AttributePlan], pred: str, label: str) -> DataFrame:
    """The same as :func:`group_stats` from the rows themselves, each binned in the scan stage."""
    items = []
    for p in plans:
        group, order = p.group(df)
        items.append(F.struct(F.lit(p.column).alias("attribute"), group.alias("grp"), order.alias("grp_ord")))
    return _rates(_audit_counts(df, items, ["attribute", "grp", "grp_ord"], pred, label))


def _rates(agg: DataFrame) -> DataFrame:
    return agg.select(
        "attribute", "grp", "grp_ord", "n", "n_pred_pos", "n_pos", "n_true_pos",
        (F.col("n_pred_pos") / F.col("n")).alias("positive_rate"),
        # a group without positives counts with TPR 0.0
        F.when(F.col("n_pos") > 0, F.col("n_true_pos") / F.col("n_pos"))
         .otherwise(F.lit(0.0)).alias("tpr"),
    )


def attribute_report(groups: DataFrame, plans: Sequence[AttributePlan]) -> DataFrame:
    """DPD / EOD per attribute with best and worst groups and breach flags."""
    types = F.create_map(*[x for p in plans for x in (F.lit(p.column), F.lit(p.attr_type))]) \
        if plans else F.create_map()
    real = F.col("grp").isNotNull()

    def pick(metric: str, sign: int):
        key = F.struct((F.lit(sign) * F.col(metric)).alias("k"), F.col("grp_ord"), F.col("grp"))
        return F.min_by(F.when(real, F.col("grp")), F.when(real, key))

    agg = groups.groupBy("attribute").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count(F.when(real, 1)).alias("_n_real"),
        F.max(F.when(real, F.col("positive_rate"))).alias("_r_max"),
        F.min(F.when(real, F.col("positive_rate"))).alias("_r_min"),
        F.max(F.when(real, F.col("tpr"))).alias("_t_max"),
        F.min(F.when(real, F.col("tpr"))).alias("_t_min"),
        pick("positive_rate", -1).alias("_dpd_max_group"),
        pick("positive_rate", 1).alias("_dpd_min_group"),
        pick("tpr", -1).alias("_eod_max_group"),
        pick("tpr", 1).alias("_eod_min_group"),
        F.sum("n").alias("n_rows"),
    )
    two = F.col("_n_real") >= 2
    dpd = F.when(two, F.col("_r_max") - F.col("_r_min")).otherwise(F.lit(0.0))
    eod = F.when(two, F.col("_t_max") - F.col("_t_min")).otherwise(F.lit(0.0))
    out = agg.select(
        "attribute",
        types[F.col("attribute")].alias("attribute_type"),
        "n_groups", "n_rows",
        dpd.alias("dpd"), eod.alias("eod"),
        F.when(two, F.col("_dpd_max_group")).alias("dpd_max_group"),
        F.when(two, F.col("_dpd_min_group")).alias("dpd_min_group"),
        F.when(two, F.col("_eod_max_group")).alias("eod_max_group"),
        F.when(two, F.col("_eod_min_group")).alias("eod_min_group"),
    )
    out = out.withColumn("dpd_flagged", F.col("dpd") >= F.lit(BIAS_THRESHOLD)) \
             .withColumn("eod_flagged", F.col("eod") >= F.lit(BIAS_THRESHOLD))
    return out.withColumn("any_breach", F.col("dpd_flagged") | F.col("eod_flagged"))


@dataclass
class AuditResult:
    plans: list[AttributePlan]
    groups: DataFrame
    report: DataFrame
    pred: str
    label: str

    def summary(self, df: DataFrame) -> DataFrame:
        """One row: threshold, attributes audited, total breaches, entities flagged."""
        r = self.report.agg(
            F.count(F.lit(1)).alias("attributes_audited"),
            F.coalesce(F.sum(F.col("dpd_flagged").cast("int") + F.col("eod_flagged").cast("int")),
                       F.lit(0)).cast("long").alias("total_breaches"),
            F.coalesce(F.max(F.col("any_breach").cast("int")), F.lit(0)).alias("_any"))
        n = df.agg(F.count(F.lit(1)).alias("entities_total"))
        both = r.crossJoin(n)  # two one-row frames
        return both.select(
            F.lit(BIAS_THRESHOLD).alias("threshold"), "attributes_audited", "total_breaches",
            F.when(F.col("_any") == 1, F.col("entities_total")).otherwise(F.lit(0))
             .cast("long").alias("entities_flagged"),
            F.col("entities_total").cast("long"),
            F.lit(True).alias("all_findings_reported"))

    def report_table(self) -> DataFrame:
        """The API-style report: statuses as text next to the numbers."""
        status = lambda c: F.when(F.col(c), "FLAGGED").otherwise("OK")
        return self.report.select(
            "attribute", "attribute_type", "n_groups", "dpd", "eod",
            status("dpd_flagged").alias("dpd_status"), status("eod_flagged").alias("eod_status"),
            "any_breach")

    def entity_flags(self, df: DataFrame, scope: str = "attribute",
                     name: str = "bias_flag") -> DataFrame:
        """Per-entity bias flag.

        ``scope="attribute"`` (parity): any breach anywhere flags every entity.
        ``scope="group"``: only entities in the max/min group of a breached
        metric are flagged.
        """
        if scope == "attribute":
            flag = self.report.agg(F.coalesce(F.max(F.col("any_breach").cast("int")),
                                              F.lit(0)).alias("_flag"))
            # one-row frame: broadcast is bounded by construction
            out = df.crossJoin(F.broadcast(flag))
            return out.withColumn(name, F.col("_flag") == 1).drop("_flag")
        if scope != "group":
            raise ValueError("scope must be 'attribute' or 'group'")
        hot = self.report.select("attribute", F.explode(F.array(
            F.when(F.col("dpd_flagged"), F.col("dpd_max_group")),
            F.when(F.col("dpd_flagged"), F.col("dpd_min_group")),
            F.when(F.col("eod_flagged"), F.col("eod_max_group")),
            F.when(F.col("eod_flagged"), F.col("eod_min_group")))).alias("grp")
        ).where(F.col("grp").isNotNull()).distinct().collect()  # <= 4 rows per attribute
        cond = F.lit(False)
        for p in self.plans:
            gs = sorted({r["grp"] for r in hot if r["attribute"] == p.column})
            if gs:
                g, _ = p.group(df)
                cond = cond | F.coalesce(g.isin(gs), F.lit(False))
        return df.withColumn(name, cond)


def fairness_audit(df: DataFrame, sensitive, pred: str, label: str) -> AuditResult:
    """Audit ``pred`` (0/1) against ``label`` (0/1) over every sensitive attribute.

    ``sensitive`` is a list of column names, (column, type) pairs or dicts with
    ``column``/``type``. Columns missing from ``df`` are skipped with a warning.
    Every finding is reported; nothing is suppressed.

    The (attribute, value) table is written to the shared checkpoint folder and
    every later step reads that reduced table. Numeric attributes of very many
    values go by column-pruned passes over the input instead: sketches, what
    lies in the quartile brackets, and the counts of each bin.
    """
    present = [c for c, _ in _normalize_sensitive(sensitive) if c in df.columns]
    if not present:
        for c, _ in _normalize_sensitive(sensitive):
            log.warning("sensitive column %r not found, skipped", c)
        spark = df.sparkSession
        empty_groups = spark.createDataFrame([], "attribute string, grp string, grp_ord double, "
                                             "n long, n_pred_pos long, n_pos long, n_true_pos long, "
                                             "positive_rate double, tpr double")
        return AuditResult([], empty_groups, attribute_report(empty_groups, []), pred, label)
    wide = wide_attributes(df, present)
    parts = []
    few = [c for c in present if c not in wide]
    values = None
    if few:
        values = reliable_checkpoint(value_table(df, few, pred, label))
    plans = plan_attributes(df, sensitive, values=values, pred=pred, label=label, wide=wide)
    if few:
        parts.append(group_stats(values, [p for p in plans if p.column in few]))
    if wide:
        parts.append(reliable_checkpoint(bin_stats(df, [p for p in plans if p.column in wide], pred, label)))
    groups = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return AuditResult(plans, groups, attribute_report(groups, plans), pred, label)
