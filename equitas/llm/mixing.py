"""Operator 8: mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .handover import WORD, columns_of, fresh, handover, only
from .prefix import prefix_sums

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
                   most: int = 2) -> DataFrame:
    """Targets in words for (source, source_size) rows, one per source.

    All sources share ``share`` times the sum of sizes by weight; a target
    stops at ``most`` times its source's size and the excess is shared again by
    weight until none is above. In order of cap over weight the capped sources
    come first: source k is capped when its cap per weight is at most the level
    (what is left of the total, per weight left) after all before it.

    Returns source, position (from 0, code points, null last), source_size,
    weight, target. A source without words has target 0. The windows run over
    one row per source, their totals.
    """
    table = F.array(*(F.lit(int(w)) for w in weights))
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1
    weighed = sizes.select("source", position.alias("position"), "source_size").select(
        "*", F.element_at(table, (F.col("position") % len(weights)).cast("int") + 1).cast("long").alias("weight"),
        (most * F.col("source_size")).alias("cap"))
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("position").asc()]
    everything = Window.partitionBy()
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = [(F.sum(c).over(everything) * k - F.coalesce(F.sum(what).over(before), F.lit(0)))
             for c, k, what in (("source_size", F.lit(float(share)), "cap"), ("weight", F.lit(1), "weight"))]
    stacked = weighed.withColumn("level", after[0] / after[1])
    # the first source that stays below its cap sets the level of all later ones
    low = F.col("cap") > F.col("level") * F.col("weight")
    level = F.min_by("level", F.when(low, F.struct(F.col("cap") / F.col("weight"), "position"))).over(everything)
    flat = F.coalesce(level * F.col("weight"), F.col("cap").cast("double"))
    return stacked.select("source", "position", "source_size", "weight",
                          F.least(F.col("cap").cast("double"), flat).alias("target"))


def size_rates(sizes: DataFrame) -> DataFrame:
    """Inclusion probability per word of each source: documents count by min(1, rate x size).

    ``sizes`` has position, size, ``open`` (words the sample of the source wants)
    and n (documents of that size). The largest documents are certain; ``rate``
    shares what they leave over the squares of the other sizes, so that the
    expected words are ``open``. Its windows run over the distinct sizes of a
    source, which the longest document bounds.
    """
    n, size = F.col("n").cast("decimal(20,0)"), F.col("size").cast("decimal(12,0)")
    larger = Window.partitionBy("position").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("position").orderBy(F.col("size").desc()).rowsBetween(
        Window.currentRow, Window.unboundedFollowing)
    left = F.col("open") - F.coalesce(F.sum(n * size).over(larger), F.lit(0)).cast("double")
    stacked = sizes.where("size > 0").withColumn("left", left).withColumn(
        "squares", F.sum((n * size * size).cast("decimal(38,0)")).over(rest).cast("double"))
    free = F.col("left") * F.col("size") <= F.col("squares")
    return stacked.groupBy("position").agg(
        F.max_by(F.col("left") / F.col("squares"), F.when(free, F.col("size"))).alias("rate_by_size"))


def uniform(doc_id, seed: str):
    """A number inside (0, 1) that the id and the seed alone decide."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + 0.5) / F.lit(float(2 ** 48))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2,
                odds: str | None = None, seed: str = "mix") -> DataFrame:
    """Choose how often the mix takes every document, so that each source meets its target.

    A source wants target / source_size copies of each of its words. The whole
    part is certain: that many copies of every document. What is left open is
    sampled with unequal probabilities: a document's inclusion probability p is
    proportional to its size, at most 1 and such that the expected words are
    those left open (see ``size_rates``). It ranks by u / (1 - u) over its
    inclusion odds p / (1 - p), u being a uniform number from its id; certain
    ones come first. With ``odds``, the odds are instead those of the open
    fraction times the document's own value in that column (null or not
    positive: 1). The sample of the source is the start of that order, cut where
    the words taken come nearest to what is open, so its size is fixed to within
    half a document.

    Returns doc_id, size (words; null text: 0), source_size, target, taken
    (words, repeats counted), source, copies (0 to ``most``), text_crc32. Every
    row of the input gives one row. Sources may be null; a null id draws as an
    empty text. Rows that repeat an id draw the same number and rank side by
    side. Documents without words take 0. Reruns give the same rows, but for
    which of several wholly equal rows stands at the cut. An empty table gives
    no rows; further input columns are ignored.

    The one scan of the texts leaves (id, source, size) rows. A source of any
    size is ranked over many ranges (see ``prefix_sums``); the table of sources
    is joined by whatever way Spark's size check allows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    extra = [odds] if odds else []
    thin = handover(only(docs, "doc_id", "text", "source", *extra).select(
        "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), *extra), "sizes")
    sizes = thin.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = handover(source_targets(sizes, weights, share, most), "targets")

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # the hash stands for the source in the join, as null equals null there
    named = thin.join(targets.withColumnRenamed("source", "_source"),
                      F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    fraction = F.col("rate") - F.col("whole")
    wanted = (named.withColumn("rate", rate).withColumn("whole", F.floor("rate"))
              .withColumn("open", F.col("target") - F.col("whole") * F.col("source_size")))
    if odds:
        own = F.when(F.col(odds) > 0, F.col(odds).cast("double")).otherwise(F.lit(1.0))
        chances = F.when(fraction > 0, fraction / (1 - fraction) * own)
    else:
        # a table of known size: Spark's size check then decides the join before rows are dealt by source
        rates = handover(size_rates(wanted.where(fraction > 0).groupBy("position", "size", "open")
                                    .agg(F.count(F.lit(1)).alias("n"))), "rates")
        wanted = wanted.join(rates, "position", "left")
        p = F.col("rate_by_size") * F.col("size")
        # 1 - p is 0 for certain documents, whose odds are without bound
        chances = F.when((fraction > 0) & (p >= 1), F.lit(float("inf"))).when(
            (fraction > 0) & (p > 0), p / (1 - p))
    u = uniform(F.col("doc_id"), seed)
    wanted = wanted.withColumn("_key", u / (1 - u) / chances)
    ranked = prefix_sums(
        wanted, [F.col("_key").asc_nulls_last(), F.col("doc_id").asc_nulls_first(),
                 F.col("text_crc32"), F.col("size")],
        {"_before": "size"}, group="position")
    drawn = F.when(F.col("_key").isNotNull()
                   & (F.col("_before") + F.col("size") / 2 <= F.col("open")), 1).otherwise(0)
    copies = (F.col("whole") + drawn).cast("int")
    return ranked.select("doc_id", "size", "source_size", "target",
                         (F.col("size") * copies).alias("taken"), "source", copies.alias("copies"),
                         "text_crc32")


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2,
                    seed: str = "mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Rows that repeat an id, source and text are all taken as often as the one of
    them that is taken most.
    """
    plan = mix_sources(docs, weights, share, most, seed=seed).where("copies > 0")
    ident, source, crc, copies, copy = (fresh(docs, n) for n in ("_id", "_source", "_crc", "_copies", "_copy"))
    plan = plan.groupBy(F.col("doc_id").alias(ident), F.col("source").alias(source),
                        F.col("text_crc32").alias(crc)).agg(F.max("copies").alias(copies))
    own = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    met = docs.join(plan, F.col("doc_id").eqNullSafe(F.col(ident)) & F.col("source").eqNullSafe(F.col(source))
                    & (own == F.col(crc)))
    return met.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*columns_of(docs))
