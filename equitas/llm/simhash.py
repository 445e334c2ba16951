"""Operator 4: SimHash near-dedup by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .handover import columns_of, fresh, handover, only, width

SEED = 42
BITS = 64
#: Shingles whose bits are counted at a time.
COUNT_AT_ONCE = 1 << 15
#: Node pairs that a traversal expands at a time.
PAIRS_AT_ONCE = 1 << 19
#: Rows under one shared prefix that one task joins; larger prefixes are salted.
GROUP_ROWS = 20_000
#: Rows whose tries a task holds at a time.
ROWS_AT_ONCE = 60_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of a whole text: a bit is set if it is in over half the shingles' XXH64.

    Words are runs of other than ASCII white space, lower-cased in A-Z only; a
    text of fewer words than ``shingle`` is one shingle, one of none gives 0.
    """
    words = (text or "").encode("utf-8").lower().split()   # bytes: ASCII letters and blanks only
    if not words:
        return 0
    line, n = b" ".join(words), len(words)
    size = min(shingle, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    counts = np.zeros(BITS, np.int64)
    total = n - size + 1
    digest = xxhash.xxh64_digest       # big-endian, so bits come highest first
    for i in range(0, total, COUNT_AT_ONCE):
        j = min(total, i + COUNT_AT_ONCE)
        hashed = b"".join([digest(line[a:b], SEED) for a, b in
                           zip(starts[i:j].tolist(), ends[i + size - 1:j + size - 1].tolist())])
        bits = np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, **more) -> DataFrame:
    """(doc_id, bits, more): the fingerprint of every document as a signed long."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    bits = F.pandas_udf(run, "long")
    return only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), bits("text").alias("bits"),
        *(c.alias(name) for name, c in more.items()))


def trie_links(keys: np.ndarray, heads: np.ndarray, depth: int, budget: int) -> Iterator[tuple]:
    """Index pairs of sorted ``keys`` with equal heads that differ in at most ``budget`` bits.

    ``keys`` are distinct within a head and sorted by (head, key); the first
    ``depth`` bits of a key are its head's. A trie node is a range of the
    array. Starting with each head's root against itself, a pair of nodes goes
    to the pairs of their children; a pair of unlike children costs one bit of
    the budget, and a pair that costs more is pruned with all below it. Pairs of
    single keys go straight to their remaining bits. Depth first over blocks of
    PAIRS_AT_ONCE, so the frontier stays bounded.
    """
    starts = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
    stops = np.append(starts[1:], len(keys))
    wide = stops - starts > 1
    starts, stops = starts[wide], stops[wide]
    zero = np.zeros(len(starts), np.int64)
    work = [(depth, starts[i:i + PAIRS_AT_ONCE], stops[i:i + PAIRS_AT_ONCE], starts[i:i + PAIRS_AT_ONCE],
             stops[i:i + PAIRS_AT_ONCE], zero[i:i + PAIRS_AT_ONCE]) for i in range(0, len(starts), PAIRS_AT_ONCE)]
    ones = {}      # level -> how many keys before each index have that bit set

    def split(level: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if level not in ones:
            bit = (keys >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            ones[level] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        return hi - (ones[level][hi] - ones[level][lo])

    while work:
        level, l1, h1, l2, h2, spent = work.pop()
        same = l1 == l2
        single = ~same & (h1 - l1 == 1) & (h2 - l2 == 1)
        if single.any():
            a, b = l1[single], l2[single]
            near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
            yield a[near], b[near]
        if level == BITS:
            continue
        # a node of one key against itself has nothing below it
        live = ~single & ~(same & (h1 - l1 == 1))
        l1, h1, l2, h2, spent, same = (x[live] for x in (l1, h1, l2, h2, spent, same))
        if not len(l1):
            continue
        m1, m2 = split(level, l1, h1), split(level, l2, h2)
        apart = ~same
        parts = ((l1, m1, l2, m2, spent), (m1, h1, m2, h2, spent), (l1, m1, m2, h2, spent + 1),
                 (m1[apart], h1[apart], l2[apart], m2[apart], spent[apart] + 1))
        new = [np.concatenate([p[k] for p in parts]) for k in range(5)]
        keep = (new[1] > new[0]) & (new[3] > new[2]) & (new[4] <= budget)
        new = [x[keep] for x in new]
        for i in range(0, len(new[0]), PAIRS_AT_ONCE):
            work.append((level + 1, *(x[i:i + PAIRS_AT_ONCE] for x in new)))


def _blocks(parts: int) -> list[tuple[int, int]]:
    """(first bit, length) of ``parts`` nearly equal blocks of the fingerprint."""
    edges = [round(i * BITS / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _turned(bits, first: int):
    """The fingerprint turned left, so that the block that begins at ``first`` leads."""
    if first == 0:
        return bits
    return F.shiftleft(bits, first).bitwiseOR(F.shiftrightunsigned(bits, BITS - first))


def trie_forest(prints: DataFrame, distance: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges (a, b) that connect distinct ``bits`` exactly as all links within ``distance`` do.

    Two fingerprints that differ in at most d bits agree on one of d + 1
    blocks. So each fingerprint enters d + 1 tries, turned so that another block
    leads in each: a link is then found in a trie where the leading block costs
    nothing, and that block is the key by which the trie's subtrees are dealt
    to tasks. A subtree of more than ``group_rows`` keys is salted: its keys
    fall in chunks by hash, and each pair of chunks is a group of its own.
    Inside a task the tries of many groups are traversed together, and the
    links go into a forest at once: what leaves is one edge per key at most.
    """
    blocks = _blocks(distance + 1)
    turns = F.array(*(F.struct(F.lit(i).alias("turn"), _turned(F.col("bits"), a).alias("key"),
                               F.shiftrightunsigned(_turned(F.col("bits"), a), BITS - n).alias("head"))
                      for i, (a, n) in enumerate(blocks)))
    rows = prints.select("bits", F.explode(turns).alias("t")).select("bits", "t.*")
    counted = handover(rows.groupBy("turn", "head").count().where(F.col("count") > 1), "heads")
    chunks = F.ceil(F.col("count") / group_rows).cast("int")
    met = rows.join(counted, ["turn", "head"])
    own = F.pmod(F.xxhash64("bits"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    dealt = met.withColumn("_own", own).withColumn("_other", other).select(
        "turn", "head", F.least("_own", "_other").alias("c1"), F.greatest("_own", "_other").alias("c2"),
        "bits", "key")
    group = ["turn", "head", "c1", "c2"]
    ordered = dealt.repartition(4 * width(prints.sparkSession), *group).sortWithinPartitions(*group)
    depth = [n for _, n in blocks]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def joined(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for turn, rows in part.groupby("turn"):
                key = rows["key"].to_numpy().view(np.uint64)
                head = rows.groupby(group, sort=False).ngroup().to_numpy()
                order = np.lexsort((key, head))
                key, head, bits = key[order], head[order], rows["bits"].to_numpy()[order]
                forest = Forest(len(key))
                for a, b in trie_links(key, head, depth[turn], distance):
                    forest.union(a, b)
                top = forest.roots()
                far = np.flatnonzero(top != np.arange(len(top)))
                if len(far):
                    yield pd.DataFrame({"a": bits[far], "b": bits[top[far]]})

        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= ROWS_AT_ONCE:
                part = pd.concat(held, ignore_index=True)
                last = (part[group] == part[group].iloc[-1]).all(axis=1).to_numpy()
                yield from joined(part[~last])     # the last group may go on in the next batch
                held, size = [part[last]], int(last.sum())
        if held:
            yield from joined(pd.concat(held, ignore_index=True))

    return ordered.mapInPandas(run, "a long, b long")


def near_groups(docs: DataFrame, shingle: int = 4, distance: int = 4,
                group_rows: int = GROUP_ROWS) -> DataFrame:
    """The group of near-duplicates of every document.

    Returns doc_id, fingerprint (16 lowercase hex digits) and component_id, the
    smallest doc_id that links of at most ``distance`` bits reach, itself
    included. Texts without words (null, empty, white space only) have
    fingerprint 0 and link like any other. A group whose ids are all null has a
    null component_id. Rows that repeat are each returned. An empty table gives
    no rows; further input columns are ignored.

    Documents with one fingerprint become one row before any join, by an
    aggregation with map-side partials. The join back is on the fingerprint;
    Spark splits a very common one.
    """
    prints = handover(fingerprints(docs, shingle), "fingerprints")
    return _with_least(prints, distance, group_rows, component_id=F.col("doc_id")).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def _with_least(prints: DataFrame, distance: int, group_rows: int, **least) -> DataFrame:
    """``prints`` with the smallest value of each of ``least`` in the row's group of linked fingerprints."""
    smallest = [F.min(name).alias(name) for name in least]
    distinct = handover(prints.groupBy("bits").agg(*(F.min(c).alias(name) for name, c in least.items())), "distinct")
    edges = handover(trie_forest(distinct.select("bits"), distance, group_rows), "forest")
    grouped = handover(components(edges), "components")
    member = distinct.join(grouped, distinct["bits"] == grouped["node"], "left").select(
        "bits", *least, F.coalesce("component", "bits").alias("component"))
    first = member.groupBy("component").agg(*smallest)
    named = member.select("bits", "component").join(first, "component").select("bits", *least)
    return prints.join(named, "bits")


def _row_key():
    """What tells rows apart: a digest of id and text; null ids as one, null text as empty."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.concat(ident, F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary"), 256))


def drop_near_copies(docs: DataFrame, shingle: int = 4, distance: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest id, with all its columns.

    Rows are told apart by id and text, not by id alone: of rows that share an
    id the one of the smallest digest stays, and of rows that repeat id and text
    one. Of a group's rows with a null id one stays as well, also beside a row
    with an id, as nothing names it.

    Only rows that go or repeat are looked up, so texts move at most once;
    repeated rows are combined where they lie before any is exchanged.
    """
    prints = handover(fingerprints(docs, shingle, key=_row_key()), "fingerprints")
    ident = F.col("doc_id")
    found = _with_least(prints, distance, group_rows, named=F.when(ident.isNotNull(), F.struct("doc_id", "key")),
                        nameless=F.when(ident.isNull(), F.col("key")))
    stays = F.when(ident.isNull(), F.col("key") == F.col("nameless")).otherwise(F.col("key") == F.col("named.key"))
    name, row = fresh(docs, "_row_key"), fresh(docs, "_row")
    marked = handover(found.groupBy(F.col("key").alias(name)).agg(
        F.max(stays).alias("_stays"), F.count(F.lit(1)).alias("_rows")).where("not _stays or _rows > 1"), "marked")
    keyed = docs.withColumn(name, _row_key())
    once = (keyed.join(marked.where("_stays").select(name), name, "left_semi").groupBy(name)
            .agg(F.first(F.struct(*columns_of(docs))).alias(row)).select(F.col(f"{row}.*")))
    return keyed.join(marked.select(name), name, "left_anti").select(*columns_of(docs)).union(once)
