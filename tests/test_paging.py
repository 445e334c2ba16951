"""Pages through the order-statistic index, against a plain sort."""

import pytest
from pyspark.sql import functions as F

from equitas.operators.gold import gold_page, sort_gold
from equitas.operators.paging import page_index


@pytest.fixture(scope="module")
def gold(spark):
    # a third of all rows share one score
    score = F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 7919 % 1000) / 1000)
    return spark.range(2000).select(
        F.format_string("E-%05d", F.col("id")).alias("entity_id"), score.alias("risk_score"),
        F.array(F.lit("a")).alias("top_factors"), F.lit("r").alias("reason_text"),
        F.when(score > 0.7, "High").when(score >= 0.4, "Medium").otherwise("Low").alias("intervention_tier"),
        (F.col("id") % 5 == 0).alias("bias_flag"))


def test_every_page_equals_the_sorted_slice(gold):
    want = [tuple(r) for r in sort_gold(gold).collect()]
    index = page_index(gold, [F.col("risk_score").desc(), F.col("entity_id").asc()], ranges=7)
    try:
        assert index.total == 2000 and index.pages(300) == 7
        for n in range(1, 9):
            assert [tuple(r) for r in index.page(n, 300).collect()] == want[(n - 1) * 300:n * 300]
    finally:
        index.close()


@pytest.mark.parametrize("page", [1, 2, 13, 40])
@pytest.mark.parametrize("sort_by,desc", [("risk_score", True), ("entity_id", False)])
def test_gold_page(gold, page, sort_by, desc):
    rows = sort_gold(gold.where("bias_flag and intervention_tier = 'Medium'"), sort_by, desc).collect()
    got = gold_page(gold, page, 20, tier="Medium", bias_only=True, sort_by=sort_by, desc=desc).collect()
    assert got == rows[(page - 1) * 20:page * 20]


def test_a_page_opens_only_its_ranges(gold):
    index = page_index(gold, [F.col("risk_score").desc(), F.col("entity_id").asc()], ranges=8)
    try:
        (held,) = [r for r, before, n in index.starts if before <= 1000 and 1005 <= before + n]
        page = index.rows(1000, 5)
        assert page.count() == 5
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" not in plan
        assert f"PartitionFilters: [isnotnull(_range#" in plan and f" = {held})]" in plan
    finally:
        index.close()


def test_no_rows_no_pages(gold):
    index = page_index(gold.where("false"), [F.col("entity_id").asc()])
    assert index.total == 0 and index.pages(50) == 0 and index.page(1).count() == 0
    index.close()
    with pytest.raises(ValueError):
        gold_page(gold, 0)
