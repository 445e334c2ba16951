"""Gold table: one row per entity with score, factors, reason, tier and flag.

Plus the read-side operators over it: filter by tier / bias, sort, page,
summary, tier shares and keyed entity lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import entity_id, intervention_tier, reason_text
from ..plans.prefix import row_index
from .attribution import factor_names
from .paging import PageIndex, page_index

GOLD_COLUMNS = ("entity_id", "risk_score", "top_factors", "reason_text",
                "intervention_tier", "bias_flag")


def build_gold(df: DataFrame, score: str, factors: str, bias_flag: str | None = None,
               id_column: str | None = None, prefix: str = "ENT",
               order: Sequence[str] | None = None) -> DataFrame:
    """Gold rows from a frame holding a score, a factor array and a bias flag.

    Entities keep their dataset id when there is one; otherwise they get
    ``PREFIX-%05d`` of their position in ``order`` (a distributed row index).
    The tier uses the unrounded score; the stored score is rounded to 4 places.
    """
    base = df
    if id_column is None:
        if not order:
            raise ValueError("an order is needed to number entities without an id column")
        base = row_index(base, order, name="_pos")
        eid = entity_id(None, prefix, F.col("_pos"))
    else:
        eid = entity_id(F.col(id_column), prefix, None)
    tier = intervention_tier(F.col(score))
    flag = F.col(bias_flag).cast("boolean") if bias_flag else F.lit(False)
    return base.select(
        eid.alias("entity_id"),
        F.round(F.col(score), 4).alias("risk_score"),
        factor_names(F.col(factors)).alias("top_factors"),
        reason_text(F.col(factors), tier).alias("reason_text"),
        tier.alias("intervention_tier"),
        flag.alias("bias_flag"),
    )


def filter_gold(gold: DataFrame, tier: str | None = None, bias_only: bool = False) -> DataFrame:
    out = gold
    if tier:
        out = out.where(F.col("intervention_tier") == tier)
    if bias_only:
        out = out.where(F.col("bias_flag"))
    return out


def gold_order(gold: DataFrame, sort_by: str = "risk_score", desc: bool = True) -> list:
    """Sort columns: any gold column (none if unknown), and entity_id to break ties."""
    if sort_by not in gold.columns:
        return []
    return [F.col(sort_by).desc() if desc else F.col(sort_by).asc(), F.col("entity_id").asc()]


def sort_gold(gold: DataFrame, sort_by: str = "risk_score", desc: bool = True) -> DataFrame:
    """Sort by any gold column (unknown column: unsorted); entity_id breaks ties."""
    order = gold_order(gold, sort_by, desc)
    return gold.orderBy(*order) if order else gold


def gold_index(gold: DataFrame, tier: str | None = None, bias_only: bool = False, sort_by: str = "risk_score",
               desc: bool = True) -> PageIndex:
    """An index from which any page can be read; close it when done."""
    return page_index(filter_gold(gold, tier, bias_only),
                      gold_order(gold, sort_by, desc) or [F.col("entity_id").asc()])


def gold_page(gold: DataFrame, page: int = 1, page_size: int = 50, tier: str | None = None,
              bias_only: bool = False, sort_by: str = "risk_score", desc: bool = True) -> DataFrame:
    """One page (1-based). The first is a top-k of its own size; a deeper one is read through an index made
    for it, and its rows (500 at most) are held so that the index can go. For several pages use
    :func:`gold_index`."""
    if page < 1 or not (1 <= page_size <= 500):
        raise ValueError("page >= 1 and 1 <= page_size <= 500")
    if page == 1:
        return sort_gold(filter_gold(gold, tier, bias_only), sort_by, desc).limit(page_size)
    index = gold_index(gold, tier, bias_only, sort_by, desc)
    try:
        return gold.sparkSession.createDataFrame(index.page(page, page_size).collect(), gold.schema)
    finally:
        index.close()


def gold_summary(gold: DataFrame, tier: str | None = None, bias_only: bool = False,
                 page_size: int = 50) -> DataFrame:
    """Totals, tier counts, flagged count and rate, average (rounded) score, pages."""
    g = filter_gold(gold, tier, bias_only)
    n = F.count(F.lit(1))
    return g.agg(
        n.alias("total_entities"),
        F.count_if(F.col("intervention_tier") == "High").alias("high_risk_count"),
        F.count_if(F.col("intervention_tier") == "Medium").alias("medium_risk_count"),
        F.count_if(F.col("intervention_tier") == "Low").alias("low_risk_count"),
        F.count_if(F.col("bias_flag")).alias("bias_flagged"),
        F.coalesce(F.avg(F.col("bias_flag").cast("double")), F.lit(0.0)).alias("bias_rate"),
        F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("avg_risk_score"),
        F.floor((n + F.lit(page_size - 1)) / F.lit(page_size)).cast("long").alias("total_pages"),
    )


def tier_share(gold: DataFrame) -> DataFrame:
    """Tier, count and percent of all entities (three rows)."""
    counts = gold.groupBy("intervention_tier").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over three rows
    return counts.select("intervention_tier", "n", (F.col("n") * 100.0 / total).alias("pct"))


def entity_lookup(gold: DataFrame, ids: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """Batch lookup: gold rows whose id appears in ``ids`` (a left-semi join)."""
    keys = ids.select(F.col(id_col).cast("string").alias("entity_id")).distinct()
    return gold.join(keys, "entity_id", "left_semi")


def explain_entities(attributed: DataFrame, ids: DataFrame, id_column: str, score: str = "risk_score",
                     factors: str = "factors") -> DataFrame:
    """Signed explanation of chosen entities: one row per entity and factor.

    ``ids`` has the wanted ids in its first column. Returns the id, its score
    and tier, and per factor its rank, name, signed value, direction and
    magnitude. Ids that do not occur give no rows.
    """
    wanted = ids.select(F.col(f"`{ids.columns[0]}`").cast(attributed.schema[id_column].dataType)
                        .alias(id_column)).distinct()
    met = attributed.join(wanted, id_column, "left_semi")
    key = F.col(f"`{id_column}`")
    return met.select(
        key, F.col(score), intervention_tier(F.col(score)).alias("intervention_tier"),
        F.posexplode(factors).alias("_pos", "_f")).select(
        key, score, "intervention_tier", (F.col("_pos") + 1).alias("rank"), "_f.*")
