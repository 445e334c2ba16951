"""DuckDB statements for the discovery queries (see :mod:`.oracle`)."""

from __future__ import annotations

# The word lists and rules are written out here once more, so that a wrong or missing word in
# the operator does not pass by being wrong in both.
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

# Column lists of the driver tables: (name, numeric?)
SCHEMAS = {
    "region": [("r_regionkey", True), ("r_name", False)],
    "nation": [("n_nationkey", True), ("n_name", False), ("n_regionkey", True)],
    "customer": [("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True),
                 ("c_mktsegment", False)],
    "supplier": [("s_suppkey", True), ("s_name", False), ("s_nationkey", True), ("s_acctbal", True)],
    "part": [("p_partkey", True), ("p_name", False), ("p_brand", False), ("p_type", False),
             ("p_size", True), ("p_retailprice", True)],
    "orders": [("o_orderkey", True), ("o_custkey", True), ("o_orderstatus", False),
               ("o_totalprice", True), ("o_orderdate", False), ("o_orderpriority", False)],
    "lineitem": [("l_orderkey", True), ("l_partkey", True), ("l_suppkey", True), ("l_linenumber", True),
                 ("l_quantity", True), ("l_extendedprice", True), ("l_discount", True), ("l_tax", True),
                 ("l_returnflag", False), ("l_linestatus", False), ("l_shipdate", False)],
    "events": [("event_id", True), ("ts", False), ("user_id", True), ("event_type", False),
               ("value", True), ("props", False)],
    "documents": [("doc_id", True), ("text", False), ("lang", False), ("source", False), ("n_chars", True)],
    "embeddings": [("vec_id", True), ("embedding", False), ("label", True)],
    "pages": [("page_id", True), ("url", False), ("html", False)],
    "benchmark": [("item_id", True), ("text", False)],
    "labels": [("doc_id", True), ("quality", True), ("toxic", True)],
    "conversations": [("conv_id", True), ("turn", True), ("role", False), ("text", False)],
}

QUOTE = "'"
NORM = "translate(trim(lower(col)), '''\"', '')"


def _lit(v) -> str:
    return "NULL" if v is None else QUOTE + str(v).replace(QUOTE, QUOTE * 2) + QUOTE


def discovery_ctes(match: str) -> str:
    cat = []
    for t, cols in SCHEMAS.items():
        for i, (c, num) in enumerate(cols):
            cat.append(f"SELECT '{t}' AS tbl, '{c}' AS col, {i} AS position, {str(num).lower()} AS isn, "
                       f"(SELECT count(DISTINCT {c}) / greatest(count(*), 1) > 0.95 AND count(*) > 10 "
                       f"FROM {t}) AS lid, (SELECT count(DISTINCT {c}) <= 15 FROM {t}) AS lc")
    rules = []
    for prio, (cls, st, grp, words, how, conf, meth) in enumerate(RULES):
        for w in words:
            rules.append(f"({prio}, {_lit(cls)}, {_lit(st)}, {_lit(grp)}, {_lit(w)}, {_lit(how)}, "
                         f"{_lit(conf)}, {_lit(meth)})")
    if match == "reference":
        both = "contains(c2.norm, r.keyword) OR contains(r.keyword, c2.norm)"
    else:
        both = ("contains(' ' || regexp_replace(c2.norm, '[^a-z0-9]+', ' ', 'g') || ' ', "
                "' ' || regexp_replace(r.keyword, '[^a-z0-9]+', ' ', 'g') || ' ')")
    return (
        "WITH cat AS (" + " UNION ALL ".join(cat) + "), "
        "rules(priority, cls, st, fg, keyword, how, conf, meth) AS (VALUES " + ", ".join(rules) + "), "
        f"c2 AS (SELECT *, {NORM} AS norm FROM cat), "
        "hits AS (SELECT c2.*, r.* FROM c2 LEFT JOIN rules r ON CASE r.how WHEN 'exact' THEN c2.norm = r.keyword "
        f"WHEN 'both' THEN ({both}) ELSE contains(c2.norm, r.keyword) END), "
        "best AS (SELECT tbl, col, any_value(position) AS position, any_value(isn) AS isn, any_value(lid) AS lid, "
        "any_value(lc) AS lc, arg_min({'cls': cls, 'st': st, 'fg': fg, 'conf': conf, 'meth': meth}, priority) AS r "
        "FROM hits GROUP BY tbl, col), "
        "cl AS (SELECT tbl, col, position, lid, "
        "coalesce(r.cls, CASE WHEN lid THEN 'identifier' ELSE 'profile' END) AS class, r.st AS sensitive_type, "
        "coalesce(r.fg, CASE WHEN lid THEN 'identifier' WHEN isn THEN 'numerical' WHEN lc THEN 'categorical' "
        "ELSE 'numerical' END) AS feature_group, coalesce(r.cls = 'target', false) AS is_target, "
        "r.st IS NOT NULL AS is_sensitive, coalesce(r.conf, CASE WHEN lid THEN 'medium' ELSE 'low' END) AS confidence, "
        "coalesce(r.meth, 'heuristic') AS method, (r.cls IS NULL OR r.meth = 'heuristic') AS ambiguous "
        "FROM best)")


CLASSIFIED = ("SELECT tbl AS \"table\", col AS \"column\", position, class, sensitive_type, feature_group, "
              "is_target, feature_group = 'identifier' AS is_identifier, is_sensitive, confidence, method, "
              "ambiguous FROM cl")

_fallback = ", ".join(_lit(x) for x in TARGET_FALLBACK_NAMES)
PREFIX_CASE = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(txt, '{w}')" for w in words) + f" THEN '{p}'"
    for p, words in PREFIX_WORDS) + " ELSE 'ENT' END"
PICKS = (
    ", t1 AS (SELECT tbl, "
    "coalesce(max_by(CASE WHEN is_target THEN col END, CASE WHEN is_target THEN position END), "
    f"min_by(CASE WHEN {NORM} IN ({_fallback}) THEN col END, "
    f"CASE WHEN {NORM} IN ({_fallback}) THEN position END), "
    "max_by(col, position)) AS target_column, "
    "max_by(CASE WHEN feature_group = 'identifier' THEN col END, "
    "CASE WHEN feature_group = 'identifier' THEN position END) AS id_rule, "
    "string_agg(lower(col), ' ' ORDER BY position) AS names, "
    "string_agg(CASE WHEN is_sensitive THEN col END, '|' ORDER BY position) AS sensitive_columns, "
    "string_agg(CASE WHEN is_sensitive THEN sensitive_type END, '|' ORDER BY position) AS sensitive_types, "
    "count_if(is_sensitive) AS total_sensitive, count(*) AS total_columns FROM cl GROUP BY tbl), "
    "t2 AS (SELECT t1.*, coalesce(id_rule, (SELECT min_by(cl.col, cl.position) FROM cl WHERE cl.tbl = t1.tbl "
    "AND cl.lid AND cl.col <> t1.target_column)) AS id_column, names || ' ' || lower(target_column) AS txt FROM t1)")

SQL: dict[str, str] = {
    "discover_columns": discovery_ctes("reference") + " " + CLASSIFIED,
    "discover_columns_token": discovery_ctes("token") + " " + CLASSIFIED,
    "schema_pick": discovery_ctes("reference") + PICKS + (
        f" SELECT tbl AS \"table\", target_column, id_column, {PREFIX_CASE} AS entity_prefix, "
        "coalesce(sensitive_columns, '') AS sensitive_columns, coalesce(sensitive_types, '') AS sensitive_types, "
        "total_sensitive, total_columns FROM t2"),
    "schema_summary": discovery_ctes("reference") + PICKS + (
        ", g AS (SELECT tbl, position, col, feature_group FROM cl WHERE feature_group IN "
        "('demographic', 'financial', 'temporal', 'categorical', 'numerical', 'identifier') "
        "UNION ALL SELECT cl.tbl, cl.position, cl.col, 'identifier' FROM cl JOIN t2 ON cl.tbl = t2.tbl "
        "AND cl.col = t2.id_column WHERE cl.feature_group <> 'identifier') "
        "SELECT tbl AS \"table\", feature_group, string_agg(col, '|' ORDER BY position) AS columns, "
        "count(*) AS n_columns FROM g GROUP BY tbl, feature_group"),
}
