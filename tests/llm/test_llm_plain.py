"""Sharding, mixing, exact dedup: against plain Python over small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from equitas.llm.exact_dedup import drop_copies, exact_groups
from equitas.llm.handover import handover
from equitas.llm.mixing import mix_sources, mixed_documents, size_rates, source_targets
from equitas.llm.prefix import prefix_sums
from equitas.llm.sharding import shard_by_bytes
from conftest_llm import ODD, ODD_SCHEMA


def normal(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


def test_prefix_sums_by_group(spark):
    rows = [(i % 3, (i * 7919) % 101, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    got = prefix_sums(df, [F.col("o"), F.col("v")], {"before": "v"}, group="g").collect()
    for g in range(3):
        total = 0
        for n, (_, o, v) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))):
            row = next(r for r in got if (r.g, r.o, r.v) == (g, o, v))
            assert (row["index"], row.before) == (n, total)
            total += v


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_are_contiguous_and_even(spark, documents, shards):
    got = sorted(shard_by_bytes(documents, shards).collect(), key=lambda r: r.global_slot)
    text = {r.doc_id: r.text for r in documents.collect()}
    assert [r.doc_id for r in got] == sorted(text)
    assert [r.global_slot for r in got] == list(range(len(got)))
    total, first, seen = sum(len(t.encode()) + 1 for t in text.values()), 0, Counter()
    for r in got:
        assert r["size"] == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert r.first_byte == first and r.shard == first * shards // total
        assert r.slot == seen[r.shard] and r.grown_shard is None and r.law == "bytes"
        seen[r.shard] += 1
        first += r["size"]


def test_shards_of_odd_rows(odd, empty):
    got = shard_by_bytes(odd, 4).collect()
    assert len(got) == len(ODD)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter(
        (d[0], len((d[1] or "").encode()) + 1) for d in ODD)
    assert shard_by_bytes(empty).count() == 0


def poured(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by sharing out again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not over:
            out.update({s: weight[s] * level for s in open_})
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 50, "d": 7, None: 300}, {"x": 0, "y": 10}, {None: 5},
    {f"s{i}": (i * 37) % 91 for i in range(40)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(poured(sizes))


def test_mix_meets_targets(documents):
    got = mix_sources(documents).collect()
    by = defaultdict(list)
    for r in got:
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        by[r.source].append(r)
    sizes = {s: sum(r["size"] for r in rows) for s, rows in by.items()}
    want = poured(sizes)
    for s, rows in by.items():
        assert rows[0].target == pytest.approx(want[s]) and rows[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in rows) - want[s]) <= max(r["size"] for r in rows) / 2 + 1
        assert max(r.copies for r in rows) - min(r.copies for r in rows) <= 1
    again = {(r.doc_id, r.taken) for r in mix_sources(documents.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_rates_by_size_equal_brute_force(spark):
    """Probabilities min(1, c x size) whose expected words are those wanted, c by bisection."""
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for k in range(12):
        sizes = [int(x) for x in np.unique(rng.integers(0, 400 if k % 2 else 20, 15))]
        counts = [int(x) for x in rng.integers(1, 9, len(sizes))]
        words = sum(a * b for a, b in zip(sizes, counts))
        wanted = float(words * rng.uniform(0.01, 0.99))
        rows += [(k, s, wanted, n) for s, n in zip(sizes, counts)]
        low, high = 0.0, 1e6
        for _ in range(200):
            c = (low + high) / 2
            low, high = (c, high) if sum(n * s * min(1, c * s) for s, n in zip(sizes, counts)) < wanted else (low, c)
        want[k] = low
    got = {r["position"]: r["rate_by_size"] for r in size_rates(
        spark.createDataFrame(rows, "position long, size long, open double, n long")).collect()}
    assert got == pytest.approx(want, rel=1e-6)


def test_mix_prefers_by_size(spark):
    """Large documents are certain, and of the others those of more words are taken more often."""
    rows = [(i, "w " * (2000 if i < 2 else 8 if i % 2 else 2), None, "s", 0) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mix_sources(df, share=0.5).collect()
    assert all(r.copies == 1 for r in got if r["size"] == 2000)
    share = {n: np.mean([r.copies for r in got if r["size"] == n]) for n in (2, 8)}
    assert share[8] > 2 * share[2] > 0
    assert abs(sum(r.taken for r in got) - 0.5 * sum(r["size"] for r in got)) <= 1000


def test_mix_by_own_odds(spark):
    rows = [(i, "one two three", None, "s" if i % 2 else "t", 100.0 if i < 20 else 0.01) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, w double")
    got = mix_sources(df, share=1.0, odds="w").where("source = 't'").collect()
    lucky = [r.copies for r in got if r.doc_id < 20]
    others = [r.copies for r in got if r.doc_id >= 20]
    assert sum(lucky) / len(lucky) > sum(others) / len(others)


def test_mix_of_odd_rows(odd, empty):
    got = mix_sources(odd).collect()
    assert len(got) == len(ODD)
    assert all(r.taken <= 2 * r["size"] for r in got)
    assert mix_sources(empty).count() == 0
    mixed = mixed_documents(odd)
    assert mixed.columns == odd.columns
    copies = {(r.doc_id, r.source, r.text_crc32): r.copies for r in got}
    for key, n in Counter((r.doc_id, r.source, zlib.crc32((r.text or "").encode())) for r in mixed.collect()).items():
        rows = sum((d[0], d[3], zlib.crc32((d[1] or "").encode())) == key for d in ODD)
        assert copies[key] <= n / rows <= 2
    assert mixed_documents(empty).count() == 0


@pytest.mark.parametrize("fan_in", [2, 16])
def test_exact_groups(spark, documents, fan_in):
    rows = documents.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r.text)].append(r.doc_id)
    got = {r.doc_id: r for r in exact_groups(documents.repartition(11), fan_in).collect()}
    assert len(got) == len(rows)
    for t, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (min(ids), len(ids), i == min(ids))
            assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_exact_groups_of_a_hot_text(spark):
    df = spark.range(0, 3000, 1, 23).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("same  text")).otherwise(
            F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = exact_groups(df, 4)
    assert got.where("kept").count() == 1001
    assert got.where("group_size = 2000").select("keep_id").distinct().collect()[0][0] == 1


def test_exact_dedup_of_odd_rows(odd, empty):
    got = exact_groups(odd).collect()
    assert len(got) == len(ODD)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1}
    by = defaultdict(set)
    for d in ODD:
        by[hashlib.sha256(normal(d[1]).encode()).hexdigest()].add(d[0])
    for r in got:
        ids = by[r.text_sha256] - {None}
        assert r.keep_id == (min(ids) if ids else None)
    left = drop_copies(odd)
    assert left.columns == odd.columns
    assert Counter(normal(r.text) for r in left.collect()) == Counter({normal(d[1]): 1 for d in ODD})
    assert exact_groups(empty).count() == 0 and drop_copies(empty).count() == 0


def test_handover_of_nothing(spark):
    df = handover(spark.createDataFrame([], ODD_SCHEMA), "none")
    assert df.count() == 0 and len(df.columns) == 5
