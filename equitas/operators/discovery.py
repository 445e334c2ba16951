"""Schema discovery over a column catalog.

The catalog has one row per (table, column) with its position, type and, for the
columns that names leave open, profile flags (that part scans the rows). Classification is
one join of the catalog with a small, fixed rules table (broadcast: its size
is the keyword lists below) and a ``min_by`` on rule priority per column, so a
whole lakehouse is classified in one job. Picks (target, id, prefix) and
feature groups are per-table aggregates over the catalog.

``match="reference"`` keeps two-way substring matching (a column named
``salary`` contains ``y`` and so becomes a target); ``match="token"`` matches
whole words only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .profile import (LIKELY_ID_MIN_ROWS, LIKELY_ID_RATIO, LOW_CARDINALITY_MAX, count_values, is_numeric)

# Keyword lists, in rule order.
TARGET_WORDS = ("target", "label", "outcome", "default", "churn", "result", "status", "class",
                "prediction", "y", "dropout", "hired", "approved", "survived", "diagnosis", "fraud",
                "attrition", "income")
GENDER_WORDS = ("gender", "sex", "male", "female")
SOCIOECONOMIC_WORDS = ("income", "fees", "debt", "tuition", "scholarship", "financial", "economic",
                       "socioeconomic", "poverty", "wage", "salary", "displaced", "debtor",
                       "credit_score", "credit score", "annual_income", "annual income",
                       "household_income")
RACE_WORDS = ("race", "ethnicity", "nationality", "nacional", "national", "international", "ethnic",
              "origin", "country")
AGE_WORDS = ("age", "birth_year", "birth year", "dob", "date_of_birth")
MARITAL_WORDS = ("marital", "married", "marital_status", "marital status", "civil_status",
                 "civil status")
DISABILITY_WORDS = ("disability", "disabled", "special_needs", "special needs", "handicap",
                    "impairment")
RELIGION_WORDS = ("religion", "religious", "faith")
FINANCIAL_WORDS = ("tuition", "fees", "scholarship", "debtor", "debt", "loan", "gdp", "unemployment",
                   "inflation", "income", "salary", "revenue", "cost", "price", "amount", "balance",
                   "credit", "payment", "billing", "charge")
TEMPORAL_WORDS = ("date", "time", "year", "month", "day", "quarter", "semester", "week", "period",
                  "tenure", "duration", "enrollment", "hired_date")
IDENTIFIER_NAMES = ("id", "key", "uuid", "index", "record_id", "case_id", "entity_id", "user_id",
                    "customer_id", "applicant_id", "candidate_id", "patient_id", "student_id")
FAMILY_WORDS = ("mother", "father", "parent", "guardian", "spouse", "family")
EDUCATION_WORDS = ("education", "qualification", "degree", "school", "university", "grade", "gpa",
                   "score", "marks")
WORK_WORDS = ("experience", "occupation", "job", "work", "employment", "position", "department",
              "role")
# Entity prefixes and their words, in order; fallback ENT.
PREFIX_WORDS = (("STU", ("student", "dropout", "enrollment", "semester", "curricular", "gpa")),
                ("APP", ("loan", "credit", "mortgage", "default", "fico")),
                ("PAT", ("patient", "diagnosis", "clinical", "medical", "hospital")),
                ("EMP", ("employee", "hired", "candidate", "interview", "resume")),
                ("CUS", ("customer", "churn", "subscription", "purchase")))
DEFAULT_PREFIX = "ENT"
# Names that make a target when no rule found one.
TARGET_FALLBACK_NAMES = ("target", "y", "label", "class")
GROUPS = ("demographic", "financial", "temporal", "categorical", "numerical", "identifier")

# (class, sensitive type, feature group, words, match, confidence, method), in priority order.
RULES = (
    ("identifier", None, "identifier", IDENTIFIER_NAMES, "exact", "high", "rule_based"),
    ("target", None, "target", TARGET_WORDS, "both", "high", "rule_based"),
    ("gender", "gender", "demographic", GENDER_WORDS, "both", "high", "rule_based"),
    ("race_ethnicity", "race_ethnicity", "demographic", RACE_WORDS, "both", "high", "rule_based"),
    ("marital_status", "marital_status", "demographic", MARITAL_WORDS, "both", "high", "rule_based"),
    ("age", "age", "demographic", AGE_WORDS, "both", "high", "rule_based"),
    ("disability", "disability", "demographic", DISABILITY_WORDS, "both", "high", "rule_based"),
    ("religion", "religion", "demographic", RELIGION_WORDS, "both", "high", "rule_based"),
    ("socioeconomic", "socioeconomic", "financial", SOCIOECONOMIC_WORDS, "both", "high", "rule_based"),
    ("financial", None, "financial", FINANCIAL_WORDS, "both", "high", "rule_based"),
    ("temporal", None, "temporal", TEMPORAL_WORDS, "both", "high", "rule_based"),
    ("family", "socioeconomic", "demographic", FAMILY_WORDS, "contains", "medium", "heuristic"),
    ("education", None, "numerical", EDUCATION_WORDS, "contains", "medium", "heuristic"),
    ("work", None, "categorical", WORK_WORDS, "contains", "medium", "heuristic"),
)


def normalize_name(c: Column) -> Column:
    """lower, trimmed, quotes removed."""
    return F.translate(F.trim(F.lower(c)), "'\"", "")


def rules_table(spark: SparkSession) -> DataFrame:
    rows = []
    for prio, (cls, stype, group, words, how, conf, method) in enumerate(RULES):
        for w in words:
            rows.append((prio, cls, stype, group, w, how, conf, method))
    return spark.createDataFrame(rows, "priority int, class string, sensitive_type string, "
                                       "feature_group string, keyword string, how string, "
                                       "confidence string, method string")


#: Size (log2 of the registers) and relative error of the distinct sketch, and how many of its errors a
#: count may be from a threshold before it is counted exactly.
SKETCH_SIZE, SKETCH_ERROR, NEAR = 16, 0.0045, 4


def _named_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Schema metadata: one row per column; no rows are touched."""
    meta = [(name, f.name, i, f.dataType.simpleString(), is_numeric(f.dataType))
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(meta, "table string, column string, position int, dtype string, "
                                       "is_numeric boolean")


def column_catalog(tables: Mapping[str, DataFrame], match: str = "reference",
                   approx: bool = False) -> DataFrame:
    """(table, column, position, dtype, is_numeric, is_likely_id, is_low_cardinality).

    Names come first. The profile decides only the columns that no name rule
    matches and, in a table that has no identifier then, its columns up to the
    first likely one; the flags of the others are null. A distinct sketch in the
    scan tasks settles a column unless it lies near a threshold; only then are
    the column's values moved to be counted exactly (never with ``approx``). All
    columns of all tables share the jobs, whose number is fixed.
    """
    spark = next(iter(tables.values())).sparkSession
    info = _named_catalog(spark, tables)
    named = classify(info.select("*", F.lit(None).cast("boolean").alias("is_likely_id"),
                                 F.lit(None).cast("boolean").alias("is_low_cardinality")), match)
    # one row per column; the target of a table depends on names alone
    by_name = named.select("table", "column", "position", "class", "is_identifier").collect()
    target = {r["table"]: r["target_column"] for r in schema_picks(named).select("table", "target_column").collect()}
    flags: dict[tuple[str, str], tuple[bool, bool]] = {}

    def profile(columns: list[tuple[str, str]], counts: dict | None = None) -> None:
        counts = _distinct(tables, columns, approx, known=counts)
        flags.update({key: (_likely_id(*counts[key]), counts[key][1] <= LOW_CARDINALITY_MAX) for key in columns})

    profile([(r["table"], r["column"]) for r in by_name if r["class"] == "profile"])
    # a table without an identifier so far takes its first likely one: try its columns in order
    settled = {r["table"] for r in by_name if r["is_identifier"]} | {t for (t, _), f in flags.items() if f[0]}
    waiting: dict[str, list[str]] = {}
    for r in sorted(by_name, key=lambda r: r["position"]):
        if r["table"] not in settled and (r["table"], r["column"]) not in flags and r["column"] != target[r["table"]]:
            waiting.setdefault(r["table"], []).append(r["column"])
    rest = _distinct(tables, [(t, c) for t, cols in waiting.items() for c in cols], approx, low=False)
    kept: list[tuple[str, str]] = []
    for t, cols in waiting.items():
        for c in cols:
            kept.append((t, c))
            if _likely_id(*rest[t, c]):
                break
    profile(kept, rest)
    known = spark.createDataFrame([(t, c, *f) for (t, c), f in flags.items()],
                                  "table string, column string, is_likely_id boolean, is_low_cardinality boolean")
    return info.join(known, ["table", "column"], "left").select(
        "table", "column", "position", "dtype", "is_numeric", "is_likely_id", "is_low_cardinality")


def _likely_id(n: int, d: int) -> bool:
    return d / max(n, 1) > LIKELY_ID_RATIO and n > LIKELY_ID_MIN_ROWS


def _distinct(tables: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]], approx: bool, low: bool = True,
              known: dict | None = None) -> dict:
    """(table, column) -> (rows, distinct values): sketched, and exact near a threshold unless ``approx``.

    One scan sketches hashes of all columns closely enough to tell a unique
    column from one below the identifier threshold. Without ``low`` the
    low-cardinality threshold is left to a later call, which takes the counts as
    ``known``.
    """
    def near(d: int, edge: float) -> bool:
        return d * (1 - NEAR * SKETCH_ERROR) - 1 <= edge <= d * (1 + NEAR * SKETCH_ERROR) + 1

    def sketched(c):
        # whole hashes of non-null values; the sketch takes no other types as they are
        return F.hll_sketch_estimate(F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), SKETCH_SIZE))

    counts = {k: known[k] for k in columns} if known is not None else {
        k: (n, d or 0) for k, (n, d) in count_values(tables, columns, sketched).items()}
    if approx:
        return counts
    counts.update(count_values(tables, [
        k for k, (n, d) in counts.items()
        if (low and near(d, LOW_CARDINALITY_MAX)) or (known is None and near(d, LIKELY_ID_RATIO * n))], F.count_distinct))
    return counts


def classify(catalog: DataFrame, match: str = "reference") -> DataFrame:
    """One row per catalog column with class, sensitive type, group, flags."""
    spark = catalog.sparkSession
    rules = F.broadcast(rules_table(spark))  # fixed size: the keyword lists above
    cat = catalog.withColumn("norm", normalize_name(F.col("column")))
    n, k = F.col("norm"), F.col("keyword")
    if match == "reference":
        both = F.contains(n, k) | F.contains(k, n)
    elif match == "token":
        tokens = F.concat(F.lit(" "), F.regexp_replace(n, "[^a-z0-9]+", " "), F.lit(" "))
        both = F.contains(tokens, F.concat(F.lit(" "), F.regexp_replace(k, "[^a-z0-9]+", " "),
                                           F.lit(" ")))
    else:
        raise ValueError("match must be 'reference' or 'token'")
    cond = (F.when(F.col("how") == "exact", n == k)
             .when(F.col("how") == "both", both)
             .otherwise(F.contains(n, k)))
    hits = cat.join(rules, cond, "left")
    best = hits.groupBy("table", "column").agg(
        F.first("position").alias("position"), F.first("dtype").alias("dtype"),
        F.first("is_numeric").alias("is_numeric"), F.first("is_likely_id").alias("is_likely_id"),
        F.first("is_low_cardinality").alias("is_low_cardinality"),
        F.min_by(F.struct("class", "sensitive_type", "feature_group", "confidence", "method"),
                 F.col("priority")).alias("r"))
    rule_cls = F.col("r.class")
    fallback_group = (F.when(F.col("is_likely_id"), "identifier")
                       .when(F.col("is_numeric"), "numerical")
                       .when(F.col("is_low_cardinality"), "categorical")
                       .otherwise("numerical"))
    fallback_conf = F.when(F.col("is_likely_id"), "medium").otherwise("low")
    cls = F.coalesce(rule_cls, F.when(F.col("is_likely_id"), F.lit("identifier")).otherwise("profile"))
    group = F.coalesce(F.col("r.feature_group"), fallback_group)
    out = best.select(
        "table", "column", "position", "dtype",
        cls.alias("class"),
        F.col("r.sensitive_type").alias("sensitive_type"),
        group.alias("feature_group"),
        F.coalesce(rule_cls == "target", F.lit(False)).alias("is_target"),
        (group == "identifier").alias("is_identifier"),
        F.col("r.sensitive_type").isNotNull().alias("is_sensitive"),
        F.coalesce(F.col("r.confidence"), fallback_conf).alias("confidence"),
        F.coalesce(F.col("r.method"), F.lit("heuristic")).alias("method"),
        # a column is "ambiguous" when no first-phase (name) rule matched
        (rule_cls.isNull() | F.col("r.method").eqNullSafe("heuristic")).alias("ambiguous"),
        "is_likely_id",
    )
    return out


def schema_picks(classified: DataFrame) -> DataFrame:
    """Per table: target, id column, entity prefix, sensitive list, counts."""
    c = classified
    by_table = c.groupBy("table").agg(
        F.max_by(F.when(F.col("is_target"), F.col("column")),
                 F.when(F.col("is_target"), F.col("position"))).alias("_target_rule"),
        F.max_by(F.col("column"), F.col("position")).alias("_last_column"),
        # last column classified as identifier (by name or by profile heuristic)
        F.max_by(F.when(F.col("is_identifier"), F.col("column")),
                 F.when(F.col("is_identifier"), F.col("position"))).alias("_id_rule"),
        F.sort_array(F.collect_list(F.struct("position", "column", "is_likely_id"))).alias("_cols"),
        F.sort_array(F.collect_list(F.when(F.col("is_sensitive"), F.struct(
            "position", "column", "sensitive_type", "confidence")))).alias("_sens"),
        F.count(F.lit(1)).alias("total_columns"),
    )
    fallback_target = F.try_element_at(F.filter(F.col("_cols"), lambda s: normalize_name(s["column"]).isin(
        *TARGET_FALLBACK_NAMES)), F.lit(1))["column"]
    target = F.coalesce(F.col("_target_rule"), fallback_target, F.col("_last_column"))
    id_profile = F.try_element_at(F.filter(F.col("_cols"), lambda s: s["is_likely_id"] & (s["column"] != target)),
                                  F.lit(1))["column"]
    text = F.concat(F.array_join(F.transform(F.col("_cols"), lambda s: F.lower(s["column"])), " "),
                    F.lit(" "), F.lower(target))
    prefix = None
    for pfx, words in PREFIX_WORDS:
        hit = None
        for w in words:
            h = F.contains(text, F.lit(w))
            hit = h if hit is None else hit | h
        prefix = F.when(hit, pfx) if prefix is None else prefix.when(hit, pfx)
    prefix = prefix.otherwise(DEFAULT_PREFIX)
    return by_table.select(
        "table", target.alias("target_column"),
        F.coalesce(F.col("_id_rule"), id_profile).alias("id_column"),
        prefix.alias("entity_prefix"),
        F.transform(F.col("_sens"), lambda s: s["column"]).alias("sensitive_columns"),
        F.transform(F.col("_sens"), lambda s: F.struct(s["column"].alias("column"),
                                                       s["sensitive_type"].alias("type"),
                                                       s["confidence"].alias("confidence"))
                    ).alias("sensitive_attributes"),
        F.size("_sens").alias("total_sensitive"), "total_columns")


def feature_groups(classified: DataFrame, picks: DataFrame) -> DataFrame:
    """(table, feature_group, columns in position order, count). Target columns
    have no group; an id picked from the profile alone is added to the
    identifier group (and keeps its own group too)."""
    c = classified.select("table", "position", "column", "feature_group").where(
        F.col("feature_group").isin(*GROUPS))
    extra = (classified.join(picks.select("table", "id_column"), "table")
             .where((F.col("column") == F.col("id_column")) & (F.col("feature_group") != "identifier"))
             .select("table", "position", "column", F.lit("identifier").alias("feature_group")))
    both = c.unionByName(extra)
    return both.groupBy("table", "feature_group").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "column"))),
                    lambda s: s["column"]).alias("columns"),
        F.count(F.lit(1)).alias("n_columns"))


def discover(tables: Mapping[str, DataFrame], match: str = "reference",
             approx: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classified columns, per-table picks, feature groups) for every table."""
    classified = classify(column_catalog(tables, match=match, approx=approx), match=match)
    picks = schema_picks(classified)
    return classified, picks, feature_groups(classified, picks)
