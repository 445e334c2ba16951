"""Second-order boosted trees from histograms, several models in one pass per level.

Features are cut once into at most 256 bins (one byte a value), and the binned
rows are handed over as blocks in the shared folder. A level of a tree costs one
job: every task adds up gradients and hessians of its blocks per (model, node,
feature, bin) and the sums are reduced; the driver sees histograms only, whose
size depends on models, nodes, features and bins, never on rows or on how many
rows one node holds. Of two siblings the lighter one is summed, the other is
the parent less it. The model for all rows and those of the calibration folds
(rows of the own fold are left out) share every job. A table of one block has
nothing to reduce between levels, so the same steps run as one job, to the same
trees. Where the bins leave fewer possible cells (bins, label, fold) than half
the rows, rows of a cell are merged into one with their number: they move
together through every tree, and all sums are exact, so the trees are the same.

Gradients are rounded to whole multiples of a power of two that keeps all sums
exact, so the result does not depend on partitions, order or retries. A task
finds its rows' margins from the finished trees; what has been computed before
is kept by block in the executor's own scratch folder, which all its Python
workers share (Spark gives a block to any of them), and is just rebuilt where
it is missing.

Splits maximise ``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)``, both sides with a
hessian of at least ``min_child``; leaves are ``-rate * G / (H + l)``; the first
margin is 0 and the loss is logistic.
"""

from __future__ import annotations

import contextlib
import fcntl
import math
import os
import shutil
import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import parquet_handover, remove, shared_root

MOST_BINS = 256
#: Rows of a block, and the doubles of one level's histograms that tasks and driver may hold.
BLOCK_ROWS, HISTOGRAM_DOUBLES = 1 << 16, 1 << 25
#: Bytes of margins and gradients that a Python worker without a scratch folder keeps from one job to the next.
MEMO_BYTES = 512 << 20
#: Bytes of histograms that the driver takes straight from the tasks; more of them are added up in a tree of tasks.
STRAIGHT_BYTES = 64 << 20
#: Finished trees are broadcast so many at a time.
TREE_CHUNK = 20
LEAST_GAIN = 1e-6

_MEMO: OrderedDict = OrderedDict()


@dataclass
class Boosted:
    """A fitted ensemble: ``split``, ``threshold``, ``value`` and ``cover`` by (tree, node), children of i at
    2i + 1 and 2i + 2; ``split`` is -1 at leaves and -2 where there is no node."""
    features: list
    split: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray = field(default=None)
    name: str = "gbt"

    @property
    def model(self):
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of rows x features."""
        return joint_margins([self], x)[:, 0]

    def score(self, df: DataFrame, prob: str = "prob", margin: str = "margin") -> DataFrame:
        """Probability of class 1 and the margin, for every row (null features count as 0)."""
        return with_margins(df, [self], [margin]).withColumn(
            prob, F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(f"`{margin}`"))))

    def nodes(self) -> list[dict]:
        """One record per node (bounded by trees x 2^(depth + 1))."""
        return [dict(tree=int(t), node=int(n), split=int(self.split[t, n]), threshold=float(self.threshold[t, n]),
                     value=float(self.value[t, n]), cover=float(self.cover[t, n]), gain=float(self.gain[t, n]))
                for t, n in zip(*np.nonzero(self.split > -2))]

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        schema = "tree int, node int, split int, threshold double, value double, cover double, gain double"
        spark.createDataFrame(self.nodes(), schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(list(self.features), *self.split.shape)], "features array<string>, trees int, size int"
                              ).coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        shape = spark.read.parquet(f"{path}/shape").first()
        rows = spark.read.parquet(f"{path}/nodes").toPandas()       # trees x nodes rows
        size = (shape["trees"], shape["size"])
        split = np.full(size, -2)
        out = {c: np.zeros(size) for c in ("threshold", "value", "cover", "gain")}
        at = (rows["tree"].to_numpy(), rows["node"].to_numpy())
        split[at] = rows["split"]
        for c, array in out.items():
            array[at] = rows[c]
        return Boosted(list(shape["features"]), split, **out)


# ----------------------------------------------------------------------------- scoring

def codes(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Rows x features as the number of ``cuts`` of each feature that lie below the value."""
    kind = np.uint8 if max(map(len, cuts), default=0) <= 255 else np.uint16 if max(map(len, cuts)) <= 65535 else np.int64
    return np.stack([np.searchsorted(c, x[:, f], "left").astype(kind) for f, c in enumerate(cuts)], axis=1)


def distinct(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of every different one, and which of these each row equals."""
    rows = np.ascontiguousarray(coded)
    _, first, same = np.unique(rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel(),
                               return_index=True, return_inverse=True)
    return first, same


def joint_margins(models: Sequence[Boosted], x: np.ndarray) -> np.ndarray:
    """Log odds of rows x features by every model. Rows between the same thresholds are walked once."""
    if not len(x) or not x.shape[1]:
        return np.zeros((len(x), len(models))) + [m.value[:, 0].sum() for m in models]
    cuts = [np.unique(np.concatenate([m.threshold[m.split == f] for m in models])) for f in range(x.shape[1])]
    coded = codes(x, cuts)
    first, same = distinct(coded)
    if 2 * len(first) <= len(x):
        coded = coded[first]
    else:
        same = slice(None)
    flat, base = coded.ravel(), np.arange(len(coded)) * coded.shape[1]
    out = np.zeros((len(coded), len(models)))
    for m, model in enumerate(models):
        depth = (model.split.shape[1] + 1).bit_length() - 2
        for split, threshold, value in zip(model.split, model.threshold, model.value):
            at_most = np.zeros(len(split), np.int64)
            for node in np.flatnonzero(split >= 0):
                at_most[node] = np.searchsorted(cuts[split[node]], threshold[node])
            out[:, m] += value.take(_walk(flat, base, split, at_most, depth))
    return out[same]


def with_margins(df: DataFrame, models: Sequence[Boosted], names: Sequence[str]) -> DataFrame:
    """A column of margins per model (null features count as 0), all by one Python function."""
    def run(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(list(joint_margins(models, rows.fillna(0.0).to_numpy(dtype=float))), index=rows.index)

    udf = F.pandas_udf(run, "array<double>").asNondeterministic()      # once per row
    inputs = F.struct(*[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(models[0].features)])
    kept = [c for c in df.columns if c not in names]
    return df.withColumn("_margins", udf(inputs)).select(
        *[F.col(f"`{c}`") for c in kept], *[F.col("_margins")[i].alias(n) for i, n in enumerate(names)])


def own_margins(df: DataFrame, models: Sequence[Boosted], fold: str, name: str) -> DataFrame:
    """The margin of each row by the model of its fold (null features count as 0)."""
    def run(k: pd.Series, rows: pd.DataFrame) -> pd.Series:
        x, k, out = rows.fillna(0.0).to_numpy(dtype=float), k.to_numpy(), np.zeros(len(rows))
        for i, model in enumerate(models):
            if (k == i).any():
                out[k == i] = joint_margins([model], x[k == i])[:, 0]
        return pd.Series(out, index=rows.index)

    udf = F.pandas_udf(run, "double").asNondeterministic()
    inputs = F.struct(*[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(models[0].features)])
    return df.withColumn(name, udf(F.col(fold), inputs))


# ----------------------------------------------------------------------------- bins

def bin_edges(df: DataFrame, features: Sequence[str], bins: int = MOST_BINS) -> list[np.ndarray]:
    """Ascending upper edges of every bin but the last: each value of a feature with few, else quantiles."""
    cols = [F.col(f"`{f}`").cast("double") for f in features]
    about = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(c), 14)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    few = [n <= 1.2 * bins for n in about]                          # the estimate is off by some 2%
    steps = [i / bins for i in range(1, bins)]
    found = df.agg(*[(F.collect_set(c) if fits else F.percentile_approx(c, steps, 50 * bins)).alias(f"v{i}")
                     for i, (c, fits) in enumerate(zip(cols, few))]).first()
    out = []
    for values, fits in zip(found, few):
        values = np.unique(np.asarray(values or [0.0], float))
        if fits:
            values = values[:-1]                                    # nothing lies above the greatest
            if len(values) >= bins:
                values = values[np.linspace(0, len(values) - 1, bins - 1).astype(int)]
        out.append(values)
    return out


def _record(features: int) -> np.dtype:
    return np.dtype([("fold", np.int16), ("y", np.int8), ("w", float), ("bins", np.uint8, (features,))])


def _binned(one: pd.DataFrame, edges: list[np.ndarray]) -> np.ndarray:
    """Records of rows: fold, label, weight and the bins of the features."""
    out = np.zeros(len(one), _record(len(edges)))
    for i, e in enumerate(edges):
        out["bins"][:, i] = np.searchsorted(e, one[f"f{i}"].to_numpy(float), "left")
    out["y"], out["w"], out["fold"] = one["y"].to_numpy(np.int8), one["w"].to_numpy(float), one["fold"].to_numpy(np.int16)
    return out


def _block(records: np.ndarray, count: np.ndarray) -> pd.DataFrame:
    """One block, its rows in order of the fold."""
    order = np.argsort(records["fold"], kind="stable")
    r = records[order]
    return pd.DataFrame([{"block": uuid.uuid4().hex, "n": len(r), "bins": np.ascontiguousarray(r["bins"].T).tobytes(),
                          "y": r["y"].tobytes(), "w": r["w"].tobytes(), "fold": r["fold"].tobytes(),
                          "count": count[order].tobytes()}])


def _pack(batches: Iterator[pd.DataFrame], edges: list[np.ndarray], rows: int) -> Iterator[pd.DataFrame]:
    def block(parts: list[np.ndarray]) -> pd.DataFrame:
        one = np.concatenate(parts)
        return _block(one, np.ones(len(one)))

    held, n = [], 0
    for batch in batches:
        held, n = [*held, _binned(batch, edges)], n + len(batch)
        if n >= rows:
            yield block(held)
            held, n = [], 0
    if n:
        yield block(held)


def _cells(batches: Iterator[pd.DataFrame], edges: list[np.ndarray]) -> Iterator[pd.DataFrame]:
    """Each batch's different records and how often they occur."""
    for batch in batches:
        records = _binned(batch, edges)
        if len(records):
            found, count = np.unique(records.view(np.dtype((np.void, records.itemsize))), return_counts=True)
            yield pd.DataFrame({"cell": [c.tobytes() for c in found], "n": count})


def _pack_cells(batches: Iterator[pd.DataFrame], features: int) -> Iterator[pd.DataFrame]:
    held = list(batches)                                            # cells of one block
    if held:
        one = pd.concat(held, ignore_index=True)
        if len(one):
            yield _block(np.frombuffer(b"".join(one["cell"]), _record(features)), one["n"].to_numpy(float))


def _open(row) -> tuple:
    n = row["n"]
    return (row["block"], np.frombuffer(row["bins"], np.uint8).reshape(-1, n), np.frombuffer(row["y"], np.int8),
            np.frombuffer(row["w"], float), np.frombuffer(row["fold"], np.int16), np.frombuffer(row["count"], float))


# ----------------------------------------------------------------------------- tasks

@dataclass
class Grown:
    """One finished tree of every model, by (model, node): ``split``, ``bin`` (at most: left) and ``value``."""
    split: np.ndarray
    bin: np.ndarray
    value: np.ndarray


def _walk(flat: np.ndarray, base: np.ndarray, split: np.ndarray, at_most: np.ndarray, levels: int,
          at: np.ndarray | None = None) -> np.ndarray:
    """Node of each row after so many levels of one tree, from the root or from ``at`` (rows in leaves stay).

    ``flat`` has the rows' codes one after the other, the row at ``base[i]`` first.
    """
    inner = split >= 0
    feature = np.where(inner, split, 0).astype(np.int64)
    bound = np.where(inner, at_most, np.iinfo(flat.dtype).max).astype(flat.dtype)       # leaves: never to the right
    child = np.where(inner, 2 * np.arange(len(split)) + 1, np.arange(len(split)))
    at = np.zeros(len(base), np.int64) if at is None else at.astype(np.int64)
    for _ in range(levels):
        right = flat.take(base + feature.take(at)) > bound.take(at)
        at = child.take(at)
        at += right
    return at


def _ranges(fold: np.ndarray, left_out: int | None) -> list[tuple[int, int]]:
    """The stretches of a block's rows, which lie in order of the fold, that a model learns from."""
    a, b = (0, 0) if left_out is None else np.searchsorted(fold, [left_out, left_out + 1])
    return [(x, y) for x, y in ((0, int(a)), (int(b), len(fold))) if x < y]


class _State:
    """What is known of one block: margins after ``done`` trees, the gradients they give if they are ``fresh``, and the
    nodes of its rows after ``level`` levels of the next tree. With a ``file`` it stays there after ``close``."""

    def __init__(self, models: int, n: int, file=None):
        self.file, self.head, parts = file, np.zeros(4, np.int64), [8, 8, 8, 2]
        if file is None:
            kept = np.zeros(sum(parts) * models * n, np.uint8)
        else:
            size = 32 + sum(parts) * models * n
            if os.fstat(file.fileno()).st_size != size:             # new: reads as zeros
                file.truncate(0)
                file.truncate(size)
            whole = np.memmap(file, np.uint8, "r+", shape=(size,))
            self.head, kept = whole[:32].view(np.int64), whole[32:]
        at = np.cumsum([0, *parts]) * models * n
        self.margin, self.g, self.h, self.node = (
            kept[x:y].view(kind).reshape(models, n) for x, y, kind in zip(at, at[1:], (float, float, float, np.int16)))
        whole, self.done, self.level, fresh = (int(x) for x in self.head)
        self.fresh = bool(fresh)
        if file is not None and not whole:                          # new, or its task was ended while it wrote
            self.clear()
        self.head[0] = 0

    def clear(self) -> None:
        self.done, self.level, self.fresh = 0, 0, False
        self.margin[:], self.node[:] = 0, 0

    def close(self) -> None:
        if self.file is not None:
            self.head[:] = 1, self.done, self.level, self.fresh
            fcntl.flock(self.file, fcntl.LOCK_UN)
            self.file.close()

    def nbytes(self) -> int:
        return 3 * self.margin.nbytes + self.node.nbytes

    def add(self, flat: np.ndarray, base: np.ndarray, ranges: list, grown: Grown, depth: int) -> None:
        """One more finished tree."""
        for m, own in enumerate(ranges):
            for a, b in own:
                at = _walk(flat, base[a:b], grown.split[m], grown.bin[m], depth - self.level, self.node[m, a:b])
                self.margin[m, a:b] += grown.value[m].take(at)
        self.done, self.level, self.fresh = self.done + 1, 0, False
        self.node[:] = 0


def _kept_folder(run: str) -> str | None:
    """A run's folder among this executor's block files, which Spark removes with the executor at the latest."""
    top = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return f"{top}/equitas-boost-{run}" if os.path.isdir(top) else None


def _kept_file(run: str, name: str):
    """A block's state file, for this task alone; None without a folder, or while another attempt has it."""
    folder = _kept_folder(run)
    if folder is None:
        return None
    os.makedirs(folder, exist_ok=True)
    file = open(f"{folder}/{name}", "r+b", opener=lambda path, _: os.open(path, os.O_RDWR | os.O_CREAT, 0o600))
    try:
        fcntl.flock(file, fcntl.LOCK_EX | fcntl.LOCK_NB)
    except OSError:
        file.close()
        return None
    return file


def _forget(_, run: str) -> Iterator:
    folder = _kept_folder(run)
    if folder is not None:
        shutil.rmtree(folder, ignore_errors=True)
    return iter(())


def _state(block: tuple, job: dict, flat: np.ndarray, base: np.ndarray, ranges: list) -> _State:
    """Margins of a block's rows per model, gradients and hessians as whole multiples of ``job["unit"]``, and the
    rows' nodes on the job's level."""
    name, bins, y, w, _, count = block
    key, each = (job["run"], name), job["each"]
    file = _kept_file(*key) if job["share"] else None
    state = _MEMO.pop(key, None) if file is None else None
    state = state or _State(job["models"], bins.shape[1], file)
    if state.done > job["done"] or (state.done == job["done"] and state.level > job["level"]):
        state.clear()                                               # an earlier job is run again
    for chunk in range(state.done // each, len(job["chunks"])):
        for grown in job["chunks"][chunk].value[state.done - chunk * each:]:
            state.add(flat, base, ranges, grown, job["depth"])
    for grown in job["recent"][state.done - each * len(job["chunks"]):]:
        state.add(flat, base, ranges, grown, job["depth"])
    if not state.fresh:
        for m, own in enumerate(ranges):
            for a, b in own:
                p = 1 / (1 + np.exp(-state.margin[m, a:b]))
                state.g[m, a:b] = np.rint(w[a:b] * (p - y[a:b]) / job["unit"]) * count[a:b]
                state.h[m, a:b] = np.rint(w[a:b] * p * (1 - p) / job["unit"]) * count[a:b]
        state.fresh = True
    if state.level < job["level"]:
        for m, own in enumerate(ranges):
            for a, b in own:
                state.node[m, a:b] = _walk(flat, base[a:b], job["split"][m], job["bin"][m],
                                           job["level"] - state.level, state.node[m, a:b])
        state.level = job["level"]
    if file is not None:
        return state
    _MEMO[key] = state
    while len(_MEMO) > 1 and sum(s.nbytes() for s in _MEMO.values()) > MEMO_BYTES:
        _MEMO.popitem(last=False)
    return state


def _sums(blocks: Iterator[tuple], job: dict) -> Iterator[np.ndarray]:
    """This task's histograms: (slot, feature, bin, gradient or hessian)."""
    total = np.zeros((job["slots"], job["features"], job["bins"], 2))
    for block in blocks:
        bins, fold = block[1], block[4]
        flat, base = bins.T.ravel(), np.arange(bins.shape[1]) * len(bins)
        ranges = [_ranges(fold, k) for k in job["left_out"]]
        state = _state(block, job, flat, base, ranges)
        for m in range(job["models"]):
            slot = job["slot"][m]                                   # by node; -1: not summed
            if (slot < 0).all():
                continue
            low = slot[slot >= 0].min()
            n = int(slot.max()) - low + 1
            start = np.where(slot >= 0, (slot - low) * job["bins"], -1)
            for a, b in ranges[m]:
                at = start.take(state.node[m, a:b])
                rows = np.flatnonzero(at >= 0)
                at, sides = at.take(rows), [each[m, a:b].take(rows) for each in (state.g, state.h)]
                for f in range(job["features"]):
                    i = at + bins[f, a:b].take(rows)
                    for k, each in enumerate(sides):
                        total[low:low + n, f, :, k] += np.bincount(i, each, n * job["bins"]).reshape(n, job["bins"])
        state.close()
    yield total


# ----------------------------------------------------------------------------- driver

def best_splits(sums: np.ndarray, edges: Sequence[np.ndarray], ridge: float, min_child: float) -> tuple:
    """(feature or -1, bin, gain) of every node from its histogram; ties go to the first feature, then bin."""
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:, :]
    right = total - left
    score = [s[..., 0] ** 2 / (s[..., 1] + ridge) for s in (left, right, total)]
    gain = score[0] + score[1] - score[2]
    open_ = (left[..., 1] >= min_child) & (right[..., 1] >= min_child)
    open_ &= np.arange(sums.shape[2])[None, :] < np.array([[len(e)] for e in edges])
    gain = np.where(open_, gain, -np.inf).reshape(len(sums), -1)
    at = gain.argmax(axis=1)
    best = gain[np.arange(len(gain)), at]
    good = best > LEAST_GAIN
    return np.where(good, at // sums.shape[2], -1), at % sums.shape[2], np.where(good, best, 0.0)


@dataclass
class _Here:
    """Stands for a broadcast where the trees are grown inside one task."""
    value: list


class _Trainer:
    """Grows trees from histograms that ``reduce(job)`` sums; ``share`` makes finished trees known to its tasks."""

    def __init__(self, reduce, share, edges, left_out, total_weight, depth, rate, ridge, min_child, spread=False):
        self.spread = spread                                        # over tasks, whose workers change
        self.reduce, self.share, self.edges, self.left_out = reduce, share, edges, left_out
        self.depth, self.rate, self.ridge, self.min_child = depth, rate, ridge, min_child
        self.models, self.size = len(left_out), 2 ** (depth + 1) - 1
        # sums of whole numbers stay below 2^53
        self.unit = 2.0 ** -min(40, int(51 - np.log2(total_weight + 1)))
        self.run, self.chunks, self.recent = uuid.uuid4().hex, [], []
        self.bins = max(len(e) for e in edges) + 1

    def histograms(self, level: int, slot: np.ndarray, split: np.ndarray, at_most: np.ndarray) -> np.ndarray:
        job = dict(run=self.run, models=self.models, done=len(self.chunks) * TREE_CHUNK + len(self.recent),
                   each=TREE_CHUNK, share=self.spread,
                   chunks=self.chunks, recent=self.recent, depth=self.depth, left_out=self.left_out, unit=self.unit,
                   slots=int(slot.max()) + 1, features=len(self.edges), bins=self.bins, slot=slot, split=split,
                   bin=at_most, level=level)
        return self.reduce(job) * self.unit

    def tree(self) -> dict:
        """One tree of every model, level by level."""
        shape = (self.models, self.size)
        split, at_most = np.full(shape, -2), np.zeros(shape, np.int64)
        value, cover, gain = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        open_ = [(m, 0) for m in range(self.models)]                # nodes to split on this level
        parents: dict = {}
        for level in range(self.depth + 1):
            if level == 0:
                build = open_
            elif level < self.depth:                                # the lighter child of each pair
                build = [(m, n) for m, n in open_ if self._lighter(cover, m, n)]
            if level < self.depth and open_:
                slot = np.full(shape, -1)
                for i, (m, n) in enumerate(sorted(build)):
                    slot[m, n] = i
                found = self.histograms(level, slot, split, at_most)
                sums = {key: found[slot[key]] for key in build}
                for m, n in open_:
                    if (m, n) not in sums:
                        sums[m, n] = parents[m, (n - 1) // 2] - sums[m, n + 1 if n % 2 else n - 1]
                if level == 0:
                    for key in open_:
                        g, h = sums[key][0].sum(axis=0)
                        cover[key], value[key] = h, -self.rate * g / (h + self.ridge)
                feature, where, best = best_splits(np.stack([sums[k] for k in open_]), self.edges, self.ridge,
                                                   self.min_child)
                after = []
                for key, f, b, won in zip(open_, feature, where, best):
                    split[key] = f
                    if f < 0:
                        continue
                    at_most[key], gain[key] = b, won
                    left = sums[key][f, :b + 1].sum(axis=0)
                    for child, (g, h) in ((2 * key[1] + 1, left), (2 * key[1] + 2, sums[key][f].sum(axis=0) - left)):
                        node = (key[0], child)
                        cover[node], value[node] = h, -self.rate * g / (h + self.ridge)
                        after.append(node)
                parents, open_ = sums, after
            else:
                for key in open_:
                    split[key] = -1
                open_ = []
        self.recent.append(Grown(split.astype(np.int16), at_most.astype(np.uint8), np.where(split == -1, value, 0.0)))
        if len(self.recent) == TREE_CHUNK:
            self.chunks.append(self.share(self.recent))
            self.recent = []
        return dict(split=split, bin=at_most, value=value, cover=cover, gain=gain)

    @staticmethod
    def _lighter(cover: np.ndarray, m: int, n: int) -> bool:
        twin = n + 1 if n % 2 else n - 1
        return (cover[m, n], n) < (cover[m, twin], twin)


def _grow_here(blocks: Iterator[tuple], n_trees: int, settings: dict) -> Iterator[list]:
    held = list(blocks)                                             # one block, of at most BLOCK_ROWS rows and a batch
    trainer = _Trainer(lambda job: next(_sums(iter(held), job)), _Here, **settings)
    yield [trainer.tree() for _ in range(n_trees)]


def _grow(blocks, n_trees: int, settings: dict) -> list[dict]:
    context, tasks = blocks.context, blocks.getNumPartitions()

    def reduce(job: dict) -> np.ndarray:
        sums = blocks.mapPartitions(partial(_sums, job=job))
        straight = 16 * tasks * job["slots"] * job["features"] * job["bins"] <= STRAIGHT_BYTES
        return sum(sums.collect()) if straight else sums.treeReduce(np.add)     # whole numbers: in any order the same

    trainer = _Trainer(reduce, context.broadcast, **settings, spread=True)
    try:
        trees = [trainer.tree() for _ in range(n_trees)]
    finally:
        with contextlib.suppress(Exception):                        # what is left goes with the executors
            blocks.mapPartitions(partial(_forget, run=trainer.run)).count()
    for chunk in trainer.chunks:
        chunk.unpersist()
    return trees


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, weight: str, n_trees: int = 200,
                max_depth: int = 6, rate: float = 0.1, ridge: float = 1.0, min_child: float = 1.0,
                fold: str | None = None, n_folds: int = 0, whole: bool = True) -> list[Boosted]:
    """The model of all rows (unless not ``whole``), then one per fold, fitted on the other folds' rows.

    Null features count as 0. Bins per feature are 256, fewer where models x
    nodes x features would make a level's histograms larger than
    HISTOGRAM_DOUBLES. A table without rows, or of one label, gives trees of
    one leaf each.
    """
    spark, features = train.sparkSession, list(features)
    left_out = [None] * whole + list(range(n_folds))
    bins = int(max(8, min(MOST_BINS, HISTOGRAM_DOUBLES // (2 * len(left_out) * len(features) * 2 ** max_depth))))
    folder = f"{shared_root(spark)}/equitas-boost-{uuid.uuid4().hex}"
    thin = train.select(*[F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"f{i}")
                          for i, f in enumerate(features)], F.col(f"`{label}`").cast("int").alias("y"),
                        F.col(f"`{weight}`").cast("double").alias("w"),
                        (F.col(f"`{fold}`") if fold else F.lit(-1)).cast("int").alias("fold"))
    edges = bin_edges(thin, [f"f{i}" for i in range(len(features))], bins)
    total, n_rows = thin.agg(F.sum("w"), F.count(F.lit(1))).first()
    total = total or 0.0
    cells = 2 * max(1, n_folds) * math.prod(len(e) + 1 for e in edges)          # at most so many differ
    schema = "block string, n int, bins binary, y binary, w binary, fold binary, count binary"
    if 2 * cells <= n_rows:
        merged = thin.mapInPandas(partial(_cells, edges=edges), "cell binary, n long").groupBy("cell").agg(
            F.sum("n").alias("n"))
        packed = merged.repartition(max(1, -(-cells // BLOCK_ROWS)), "cell").mapInPandas(
            partial(_pack_cells, features=len(edges)), schema)
    else:
        packed = thin.mapInPandas(partial(_pack, edges=edges, rows=BLOCK_ROWS), schema)
    packed = parquet_handover(packed, folder, "blocks")
    settings = dict(edges=edges, left_out=left_out, total_weight=total, depth=max_depth, rate=rate, ridge=ridge,
                    min_child=min_child)
    n_blocks = packed.count()
    try:
        if n_blocks <= 1:                                           # nothing to reduce between levels: one job
            trees = packed.rdd.map(_open).coalesce(1).mapPartitions(
                partial(_grow_here, n_trees=n_trees, settings=settings)).first()
        else:
            # a task per core, whatever the shuffle's width: each level is a job of its own
            dealt = packed.repartition(min(n_blocks, max(2, spark.sparkContext.defaultParallelism)))
            blocks = dealt.rdd.map(_open).persist(StorageLevel.MEMORY_AND_DISK)
            trees = _grow(blocks, n_trees, settings)
            blocks.unpersist()
    finally:
        remove(spark, folder)
    out = []
    for m in range(len(left_out)):
        split, at = (np.stack([t[c][m] for t in trees]) for c in ("split", "bin"))
        threshold = np.zeros(split.shape)
        for i in zip(*np.nonzero(split >= 0)):
            threshold[i] = edges[split[i]][at[i]]
        out.append(Boosted(features, split, threshold, *(np.stack([t[c][m] for t in trees])
                                                         for c in ("value", "cover", "gain"))))
    return out
