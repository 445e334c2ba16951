"""Operator 6: embedding near-dedup in spherical k-means cells."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .handover import handover, only, width

#: Vectors that a cell aims at; one block holds twice as many at most, on average of the chunks of a cell.
CELL_ROWS = 4096
#: Vectors the centres are fitted on (those of smallest digest), and the most centres.
FIT_ROWS, MOST_CELLS = 20_000, 1024
#: Products of two blocks worked out at a time, and those of them taken again in double at a time.
PRODUCTS, AGAIN = 1 << 20, 1 << 15
#: Share of products over their bound beyond which all of a tile's are taken in full; that of a sample's pairs, besides
#: those that link, which the leading axes may leave open; and the sampled vectors that are paired to see it.
DENSE, LEFT_OPEN, TRIED_ROWS = 1 / 64, 1e-3, 2000
#: Single-precision products this near the threshold are taken again in double.
SLACK = 2e-5
#: Bytes of paired blocks that go to Python in one batch.
BATCH_BYTES = 32 << 20


def fit_centres(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means: unit centres of unit vectors, fitted by Lloyd's rounds."""
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(sample)))
    centres = sample[np.sort(rng.choice(len(sample), k, replace=False))].copy()
    for _ in range(rounds):
        home = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-300), centres)
    return np.unique(centres, axis=0)


def _reach(threshold: float) -> float:
    return (np.sqrt(max(0.0, 1 - threshold * threshold)) if threshold > 0 else np.inf) + 1e-9


def visits(unit: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of every unit vector, and which cells may hold a vector it links with.

    A vector w of cell c' is nearer to c' than to the home centre c of v, so it
    lies beyond the great circle midway between them; v's angle to that circle
    has the sine v.(c - c') / |c - c'|. If it exceeds the sine of the linking
    angle, no w beyond can link with v. So no link is lost, whatever the centres.
    """
    near = unit @ centres.T
    home = np.argmax(near, axis=1)
    gap = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 1e-24))
    margin = near[np.arange(len(unit)), home][:, None] - near
    return home, margin <= _reach(threshold) * gap[home]


def may_cross(unit: np.ndarray, own: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit vectors of the cell round ``own`` may link with one of the cell round ``other`` (as in ``visits``)."""
    return unit @ (own - other) <= _reach(threshold) * np.sqrt(max(2 - 2 * own @ other, 1e-24))


@dataclass
class Axes:
    """An orthonormal basis in order of the vectors' spread along it, and how many of its axes come first.

    With v1 on these and v2 on the others, v.w <= v1.w1 + |v2||w2|. That is one product of vectors of ``lead`` + 1
    components; pairs whose bound is under the threshold cannot link, and the few others are worked out in full.
    """
    basis: np.ndarray
    lead: int

    def short(self, unit: np.ndarray) -> np.ndarray:
        """The leading components of unit vectors, and the length of the rest."""
        first = unit @ self.basis[:, :self.lead]
        rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", first, first)))
        return np.ascontiguousarray(np.column_stack([first, rest]).astype(np.float32))


def fit_axes(sample: np.ndarray, threshold: float) -> Axes | None:
    """Axes of least ``lead`` that leave few pairs of the sample open; None where that saves nothing."""
    basis = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    tried = sample[:TRIED_ROWS]
    link = np.count_nonzero(tried @ tried.T >= threshold)
    for lead in range(4, sample.shape[1] * 3 // 4, 4):
        axes = Axes(basis, lead)
        short = axes.short(tried)
        if np.count_nonzero(short @ short.T >= threshold - SLACK) - link <= LEFT_OPEN * len(tried) ** 2:
            return axes
    return None


def _matrix(packed: list, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(-1, dim).astype(np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)    # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


@dataclass
class Block:
    """Vectors of one chunk of a cell: ids, numbers of equal rows, the unit vectors in both precisions and their bounds."""
    ids: np.ndarray
    weight: np.ndarray
    unit: np.ndarray
    single: np.ndarray
    short: np.ndarray

    @staticmethod
    def open(ids: bytes, weight: bytes, vecs: bytes, kind: str, axes: Axes | None) -> Block:
        found = np.frombuffer(ids, np.int64)
        unit = _unit(_matrix([vecs], kind, len(vecs) // (np.dtype(kind).itemsize * len(found))))
        single = unit.astype(np.float32)
        return Block(found, np.frombuffer(weight, np.int64).astype(np.float64), unit, single,
                     axes.short(unit) if axes else single)

    def where(self, rows: np.ndarray) -> Block:
        return self if rows.all() else Block(self.ids[rows], self.weight[rows], self.unit[rows], self.single[rows],
                                             self.short[rows])


def _true(over: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of a mask with few true values, eight of them looked at together."""
    flat = over.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64) != 0)
    r, c = np.nonzero(flat[:whole].reshape(-1, 8)[words])
    return np.concatenate([words[r] * 8 + c, whole + np.flatnonzero(flat[whole:])])


def _hits(one: Block, two: Block, part: slice, threshold: float, out: np.ndarray, over: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """Rows (from the part's first) and columns of the pairs that link; ``out`` and ``over`` hold the products."""
    np.matmul(one.short[part], two.short.T, out=out)
    np.greater_equal(out, np.float32(threshold - SLACK), out=over)
    at = _true(over)
    if len(at) > DENSE * out.size and one.short is not one.single:
        np.matmul(one.single[part], two.single.T, out=out)
        np.greater_equal(out, np.float32(threshold - SLACK), out=over)
        at = np.flatnonzero(over)
        unsure = np.abs(out.ravel()[at] - threshold) < SLACK
    elif one.short is one.single:
        unsure = np.abs(out.ravel()[at] - threshold) < SLACK
    else:
        unsure = np.ones(len(at), bool)
    r, c = np.divmod(at, len(two.ids))
    hit, again = ~unsure, np.flatnonzero(unsure)
    for j in range(0, len(again), AGAIN):
        k = again[j:j + AGAIN]
        hit[k] = np.einsum("ij,ij->i", one.unit[part][r[k]], two.unit[c[k]]) >= threshold
    return r[hit], c[hit]


def block_links(one: Block, two: Block, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the vectors that link across the blocks, an id of each one's group, and the weight it links with.

    A block and itself gives every vector's links inside it, with itself too.
    """
    same, n, m = one is two, len(one.ids), len(two.ids)
    forest = Forest(n if same else n + m)
    sums = np.zeros(len(forest.parent))
    step = max(1, PRODUCTS // max(1, m))
    out, over = np.empty((min(step, n), m), np.float32), np.empty((min(step, n), m), bool)
    for i in range(0, n, step):
        rows = min(step, n - i)
        r, c = _hits(one, two, slice(i, i + rows), threshold, out[:rows], over[:rows])
        if not len(r):
            continue
        r += i
        sums[:n] += np.bincount(r, two.weight[c], n)
        if not same:
            sums[n:] += np.bincount(c, one.weight[r], m)
        forest.union(r, c if same else c + n)
    some = np.flatnonzero(sums)
    ids = one.ids if same else np.concatenate([one.ids, two.ids])
    return ids[some], ids[forest.parent[some]], np.rint(sums[some]).astype(np.int64)


def near_vectors(table: DataFrame, threshold: float = 0.9, cell_rows: int = CELL_ROWS,
                 fit_rows: int = FIT_ROWS) -> DataFrame:
    """Link vectors of cosine at least ``threshold``; keep one per group.

    Returns vec_id, n_links (other rows linked directly), component_id
    (smallest vec_id that links reach, itself included), kept (vec_id equals
    component_id). Vectors that are null, empty or zero, or hold a null or
    non-finite component, link with nothing; so do vectors of unlike lengths.
    Rows with equal vectors link with each other. Rows that repeat an id all
    come back; all those of the smallest id are kept. A null id has the
    component of its group, or null, and is not kept. An empty table gives no
    rows; further columns, such as a label, are ignored.

    Vectors are packed, and equal ones, found by their 128-bit digests, become
    one. The centres are fitted on a sample of ``fit_rows`` vectors; every
    vector goes to its home cell, and cells of more than twice ``cell_rows``
    rows are cut into chunks, each of which is one block. Blocks are written once. Every
    two blocks whose cells may hold links of each other's vectors (``visits``)
    meet once, in a product whose tasks read both sides from that table: no
    vector is copied for the cells it visits, so what is on disk grows with the
    input and only the products with its square. They are taken on the leading
    axes of the sample first (``Axes``). What leaves is one edge and a count
    per vector and pair, never a row per link. Vectors of another length
    than the most frequent one have one (chunked) cell per length.
    """
    spark = table.sparkSession
    rows = only(table, "vec_id", "embedding")
    kind = "<f4" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>").alias("vec"))
    sound = (F.coalesce(F.size("vec") > 0, F.lit(False))
             & F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x)
                                   & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
             & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False)))

    def pack(vectors: pd.Series) -> pd.DataFrame:
        # adding 0 makes -0.0 equal to 0.0
        packed = [None if v is None else (np.asarray(v, kind) + 0).tobytes() for v in vectors]
        return pd.DataFrame({"vec": packed, "digest": [None if p is None else blake2b(p, digest_size=16).digest()
                                                       for p in packed]})

    packing = F.pandas_udf(pack, "vec binary, digest binary").asNondeterministic()      # once per row
    rows = handover(rows.select("vec_id", F.when(sound, F.col("vec")).alias("vec")).select(
        "vec_id", F.size("vec").alias("dim"), packing("vec").alias("packed")).select(
        "vec_id", "dim", "packed.vec", "packed.digest", F.monotonically_increasing_id().alias("row")), "vectors")
    sound = rows.where("digest is not null")
    distinct = handover(sound.groupBy("digest").agg(
        F.min("row").alias("id"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"),
        F.min("dim").alias("dim")), "distinct-vectors")
    lengths = distinct.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).first()
    if lengths is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"),
                           F.coalesce(F.col("vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))
    dim, count = lengths
    sample = distinct.where(F.col("dim") == dim).orderBy("digest").limit(fit_rows).select("digest", "id")
    fitted = rows.join(F.broadcast(sample), (rows["row"] == sample["id"])).orderBy(sample["digest"]).select(
        "vec").toPandas()["vec"]                                        # fit_rows vectors at most
    fitted = _unit(_matrix(fitted.tolist(), kind, dim))
    centres, axes = fit_centres(fitted, min(MOST_CELLS, max(8, count // cell_rows))), fit_axes(fitted, threshold)
    # a table of its own, as the planner joins by the size of the file: the vectors do not move if it is small
    repeated = handover(distinct.where("n > 1").select("digest", "id", "n"), "equal-vectors")
    firsts = sound.join(repeated, "digest", "left").where("id is null or row = id").select(
        F.col("row").alias("id"), "dim", "vec", F.coalesce("n", F.lit(1)).alias("n"))

    def place(size: pd.Series, vectors: pd.Series) -> pd.Series:
        home = -size.to_numpy()
        main = np.flatnonzero(home == -dim)
        if len(main):
            home[main] = visits(_unit(_matrix(vectors.iloc[main].tolist(), kind, dim)), centres, threshold)[0]
        return pd.Series(home)

    placed = firsts.withColumn("cell", F.pandas_udf(place, "int").asNondeterministic()("dim", "vec"))
    # one row per cell: at most MOST_CELLS and the lengths that occur
    chunks = handover(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * cell_rows)).cast("int").alias("chunks")),
                      "cells")
    dealt = placed.join(chunks, "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), "id", "n", "vec").repartition(
        4 * width(spark), "cell", "chunk").sortWithinPartitions("cell", "chunk")

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []

        def closed() -> Iterator[pd.DataFrame]:
            if not held:
                return
            one, cell = pd.concat(held, ignore_index=True), int(key[0])
            seen = [cell]
            if cell >= 0:
                seen = np.flatnonzero(visits(_unit(_matrix(one["vec"].tolist(), kind, dim)), centres,
                                             threshold)[1].any(axis=0)).tolist()
            yield pd.DataFrame([{"key": cell * 2 ** 32 + int(key[1]), "cell": cell, "seen": sorted({cell, *seen}),
                                 "ids": one["id"].to_numpy(np.int64).tobytes(),
                                 "weights": one["n"].to_numpy(np.int64).tobytes(), "vecs": b"".join(one["vec"])}])

        for batch in batches:
            for now, part in batch.groupby(["cell", "chunk"], sort=True):
                if now != key:
                    yield from closed()
                    key, held = now, []
                held.append(part)
        yield from closed()

    blocks = handover(dealt.mapInPandas(
        block, "key long, cell int, seen array<int>, ids binary, weights binary, vecs binary"), "vector-blocks")
    one, two = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in ("one", "two"))
    # each two blocks in one order only, by a rule that leaves every block first in half its pairs
    first = F.expr("one_key = two_key or (one_key < two_key) = (pmod(xxhash64(one_key), 2) = pmod(xxhash64(two_key), 2))")
    pairs = one.hint("shuffle_replicate_nl").join(
        two, first & F.array_contains("one_seen", F.col("two_cell")) & F.array_contains("two_seen", F.col("one_cell")))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        for batch in batches:
            for p in batch.itertuples(index=False):
                known = {k: known.get(k) or Block.open(
                    *of, kind, axes if p.one_cell >= 0 else None) for k, of in (
                    (p.one_key, (p.one_ids, p.one_weights, p.one_vecs)),
                    (p.two_key, (p.two_ids, p.two_weights, p.two_vecs)))}
                a, b = known[p.one_key], known[p.two_key]
                if p.one_cell != p.two_cell:
                    near, far = centres[p.one_cell], centres[p.two_cell]
                    a, b = (a.where(may_cross(a.unit, near, far, threshold)),
                            b.where(may_cross(b.unit, far, near, threshold)))
                got = block_links(a, b, threshold)
                if len(got[0]):
                    yield pd.DataFrame(dict(zip(("a", "b", "links"), got)))

    # a row of pairs has two blocks: no more of them in a batch than Python should hold
    longest = distinct.agg(F.max("dim")).first()[0]
    size, limit = 4 * cell_rows * longest * np.dtype(kind).itemsize, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(max(1, BATCH_BYTES // size)))
    try:
        found = handover(pairs.select("one_key", "one_cell", "one_ids", "one_weights", "one_vecs", "two_key", "two_cell",
                                      "two_ids", "two_weights", "two_vecs").mapInPandas(
            compare, "a long, b long, links long"), "vector-links")
    finally:
        spark.conf.set(limit, before)
    # a vector meets itself in its own block: its own n is in the sum, and one is the row itself
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    grouped = handover(components(found.select("a", "b")), "vector-components")
    member = distinct.join(links, "id", "left").join(
        grouped.withColumnRenamed("node", "id"), "id", "left").select(
            "digest", "least", F.greatest(F.coalesce("links", F.col("n")), F.col("n")).alias("links"),
            F.coalesce("component", "id").alias("component"))
    first = member.groupBy("component").agg(F.min("least").alias("component_id"))
    named = member.join(first, "component").select("digest", "links", "component_id")
    alone = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                F.col("vec_id").alias("component_id"))
    linked = sound.join(named, "digest").select(
        "vec_id", (F.col("links") - 1).alias("n_links"), "component_id")
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
