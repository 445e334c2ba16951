"""Physical-plan checks: column pruning, pushed filters and shuffle counts."""

import contextlib
import io

from pyspark.sql import functions as F

from equitas.operators.audit import value_table
from equitas.plans.catalog import scored_lineitem
from equitas.sources.tables import table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_audit_input_pass_prunes_columns_and_shuffles_once(spark):
    df = scored_lineitem(spark, SF)
    plan = _plan(value_table(df, ["l_returnflag", "l_linestatus", "l_quantity"], "pred", "y"))
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert len(read) == 1   # one scan of lineitem
    cols = set(read[0].split("struct<", 1)[1].rstrip(">").split(","))
    assert {c.split(":")[0] for c in cols} == {"l_quantity", "l_extendedprice", "l_discount",
                                               "l_returnflag", "l_linestatus"}
    assert plan.count("Exchange (") == 1
    # partial aggregation sits below the exchange (map-side combine): operators
    # are numbered from the scan up, so its number is the smaller one
    blocks = {b.split(")", 1)[0]: b for b in plan.split("\n(")[1:]}
    exchange = int(next(k for k, b in blocks.items() if b.split(")", 1)[1].strip().startswith("Exchange")))
    partial = [int(k) for k, b in blocks.items()
               if b.split(")", 1)[1].strip().startswith("HashAggregate") and "partial_count" in b]
    assert partial and max(partial) < exchange


def test_filters_reach_the_scan(spark):
    li = table(spark, SF, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    plan = _plan(li)
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    assert pushed and "EqualTo(l_returnflag,R)" in pushed[0]
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema")][0]
    assert "l_comment" not in read and "l_orderkey" in read


def test_reason_text_works_phrases_out_once(spark):
    """The display-name expressions stand in the plan once, not in every slot of every sentence."""
    from equitas.functions.text import intervention_tier, reason_text
    df = spark.sql("select array(named_struct('feature', 'someName', 'shap_value', 1.0D)) f, 0.9D s")
    out = df.select(reason_text(F.col("f"), intervention_tier(F.col("s"))).alias("t"))
    assert out.first()["t"] == "High risk primarily due to some name. Immediate review recommended."
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("(?<=[a-z])(?=[A-Z])") == 2         # plain and mitigating
