"""Narrative expressions: display names, tiers, reason sentences, entity ids.

All of them are Catalyst expressions (``regexp_replace``, ``transform``,
``format_string``), so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier cut points on the unrounded score.
HIGH_ABOVE = 0.70
MEDIUM_FROM = 0.40

# Sentence templates by tier and number of factors.
TEMPLATES = {
    "High": ("High risk due to {a}, {b}, and {c}.", "High risk due to {a} and {b}.",
             "High risk primarily due to {a}.", " Immediate review recommended."),
    "Medium": ("Moderate risk influenced by {a}, {b}, and {c}.", "Moderate risk influenced by {a} and {b}.",
               "Moderate risk influenced by {a}.", " Review within 30 days advised."),
    "Low": ("Low risk. Key factors: {a}, {b}, and {c}.", "Low risk. Key factors: {a} and {b}.",
            "Low risk. Primary factor: {a}.", " No immediate action required."),
}
MITIGATING = "(mitigating) "
# Sentence used when an entity has no factors at all.
NO_FACTORS = {"High": "High risk.", "Medium": "Moderate risk.", "Low": "Low risk."}


def display_name(col: Column) -> Column:
    """camelCase split, ``_``/``-`` to blanks, blanks squeezed, trimmed, lower case."""
    s = F.regexp_replace(col, r"(?<=[a-z])(?=[A-Z])", " ")
    s = F.translate(s, "_-", "  ")
    s = F.regexp_replace(s, r"\s+", " ")
    return F.lower(F.trim(s))


def intervention_tier(score: Column) -> Column:
    return (F.when(score > F.lit(HIGH_ABOVE), "High")
             .when(score >= F.lit(MEDIUM_FROM), "Medium")
             .otherwise("Low"))


def factor_phrases(factors: Column) -> Column:
    """Array of phrases from ``array<struct<feature, shap_value, ...>>``."""
    return F.transform(factors, lambda f: F.when(
        f["shap_value"] > 0, display_name(f["feature"])
    ).otherwise(F.concat(F.lit(MITIGATING), display_name(f["feature"]))))


def _fill(template: str, parts: Column) -> Column:
    pieces, rest = [], template
    for slot, idx in (("{a}", 1), ("{b}", 2), ("{c}", 3)):
        if slot in rest:
            before, rest = rest.split(slot, 1)
            pieces += [F.lit(before), F.element_at(parts, idx)]
    pieces.append(F.lit(rest))
    return F.concat(*pieces)


def reason_text(factors: Column, tier: Column) -> Column:
    """Plain-language reason. An empty factor list gives the tier sentence alone.

    The phrases are worked out once a row: the templates see them as a lambda's
    variable, where a plain column would be copied into every slot of every one.
    """
    def sentence(s: Column) -> Column:
        parts, own = s["parts"], s["tier"]
        n, out = F.size(parts), None
        for name, (three, two, one, suffix) in TEMPLATES.items():
            body = (F.when(n >= 3, _fill(three, parts))
                     .when(n == 2, _fill(two, parts))
                     .when(n == 1, _fill(one, parts))
                     .otherwise(F.lit(NO_FACTORS[name])))
            text = F.concat(body, F.lit(suffix))
            out = F.when(own == name, text) if out is None else out.when(own == name, text)
        return out

    bound = F.array(F.struct(factor_phrases(factors).alias("parts"), tier.alias("tier")))
    return F.element_at(F.transform(bound, sentence), 1)


def entity_id(id_col: Column | None, prefix: str, index: Column | None) -> Column:
    """Dataset id as text, else ``PREFIX-%05d`` of a 0-based position."""
    if id_col is not None:
        return id_col.cast("string")
    return F.format_string(f"{prefix}-%05d", index)


def python_list_text(arr: Column) -> Column:
    """``['a', 'b']``: the text form of factor lists in the gold table."""
    return F.concat(F.lit("["), F.array_join(
        F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
