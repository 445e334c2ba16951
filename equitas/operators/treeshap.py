"""Exact path-dependent TreeSHAP for MLlib tree ensembles, as a Spark job.

The fitted trees are small (at most ``trees x 2^(depth+1)`` nodes); rows stay
where they are and are explained batch by batch in a Pandas UDF. The algorithm
is the published path-dependent one (Lundberg, Erion and Lee, 2018, Algorithm
2), with the weighted node counts of the training data as cover and continuous
splits going left on ``x <= threshold``. What a leaf adds to a row depends only
on which features of its path the row follows, so these sums are made once per
model, for every leaf and case, and sent as a broadcast of bounded size; a row
costs one lookup a leaf.

Boosted trees are explained in log-odds space (MLlib's probability is
``sigmoid(2 * sum(weight_t * tree_t(x)))``); random forests in probability
space. ``sum(phi) + base_value`` equals the model's margin for every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .boosting import Boosted, codes, distinct


@dataclass
class TreeArrays:
    feature: np.ndarray     # -1 at leaves
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    weight: float           # scale applied to the tree's output


def _node_arrays(nodes: list, value_of, weight: float) -> TreeArrays:
    n = max(r["id"] for r in nodes) + 1
    feat = np.full(n, -1, dtype=np.int64)
    thr = np.zeros(n)
    left = np.full(n, -1, dtype=np.int64)
    right = np.full(n, -1, dtype=np.int64)
    val = np.zeros(n)
    cov = np.zeros(n)
    for r in nodes:
        i = r["id"]
        stats = list(r["impurityStats"])
        cov[i] = stats[0] if value_of == "regression" else float(sum(stats))
        val[i] = r["prediction"] if value_of == "regression" else (
            stats[1] / sum(stats) if len(stats) > 1 and sum(stats) > 0 else 0.0)
        if r["leftChild"] >= 0:
            feat[i] = r["split"]["featureIndex"]
            thr[i] = r["split"]["leftCategoriesOrThreshold"][0]
            left[i], right[i] = r["leftChild"], r["rightChild"]
    return TreeArrays(feat, thr, left, right, val, cov, weight)


def extract_trees(spark: SparkSession, model) -> tuple[list[TreeArrays], str]:
    """Node arrays of a fitted ensemble: boosted trees as they are, an MLlib model from its node table.

    An MLlib model is written under the session's checkpoint folder and its node
    table read back with Spark (bounded by trees x nodes).
    """
    if isinstance(model, Boosted):
        size = model.split.shape[1]
        left = np.arange(size) * 2 + 1
        return [TreeArrays(np.maximum(f, -1), thr, left, left + 1, val, cov, 1.0) for f, thr, val, cov in
                zip(model.split, model.threshold, model.value, model.cover)], "log_odds"
    name = type(model).__name__
    path = f"{checkpoint_dir(spark).rstrip('/')}/treeshap-{model.uid}"
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").collect()
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r["nodeData"].asDict(recursive=True))
    if "GBT" in name:
        weights = list(model.treeWeights)
        return [_node_arrays(by_tree[t], "regression", 2.0 * weights[t]) for t in sorted(by_tree)], "log_odds"
    k = len(by_tree)
    return [_node_arrays(by_tree[t], "classification", 1.0 / k) for t in sorted(by_tree)], "probability"


# ----------------------------------------------------------------------------- leaf tables

#: Bytes that the tables of one model may take, all leaves together; leaves beyond it are worked out for each row.
TABLE_BYTES = 64 << 20
#: Most features on a path for which a table is made (2^10 cases a leaf).
MOST_FEATURES = 10
#: Rows x leaves looked up at a time.
CELLS = 1 << 18


@dataclass
class LeafSet:
    """Leaves of all trees whose paths split on the same features.

    A row follows a path's splits on its k-th feature where that feature lies in
    ``(low, high]``. The features a row follows, read as bits, are its case;
    ``table[k]`` has the k-th feature's contribution for every leaf and case.
    """
    features: tuple[int, ...]
    low: np.ndarray         # leaves x features
    high: np.ndarray
    zero: np.ndarray        # share of the training data that follows the splits on a feature
    value: np.ndarray       # of the leaf, times its tree's weight
    table: np.ndarray | None = None


def _shares(zero: np.ndarray, ones: Sequence[np.ndarray], value: np.ndarray) -> list[np.ndarray]:
    """Contribution of every feature of the paths (leaves x cases each).

    ``ones[k]`` is 1 in the cases that follow the k-th feature's splits. Path
    weights are built feature by feature, then each feature's own is undone.
    """
    size = len(ones)
    z = [zero[:, k, None] for k in range(size)]
    weights = [np.ones((len(zero), ones[0].shape[-1]))]
    for depth in range(1, size + 1):
        o, own = ones[depth - 1], z[depth - 1]
        weights.append(np.zeros_like(weights[0]))
        for i in range(depth - 1, -1, -1):
            weights[i + 1] = weights[i + 1] + o * weights[i] * ((i + 1) / (depth + 1))
            weights[i] = own * weights[i] * ((depth - i) / (depth + 1))
    out = []
    for o, own in zip(ones, z):
        total, rest = np.zeros_like(weights[0]), weights[size]
        safe = np.where(own != 0, own, 1.0)
        for j in range(size - 1, -1, -1):
            hot = rest * ((size + 1) / (j + 1))
            cold = np.where(own != 0, weights[j] / safe * ((size + 1) / (size - j)), 0.0)
            total += np.where(o != 0, hot, cold)
            rest = np.where(o != 0, weights[j] - hot * own * ((size - j) / (size + 1)), rest)
        out.append(total * (o - own) * value[:, None])
    return out


def leaf_sets(trees: Sequence[TreeArrays], table_bytes: int = TABLE_BYTES) -> list[LeafSet]:
    """All leaves by the features of their paths, with tables as far as ``table_bytes`` goes, short paths first."""
    found: dict[tuple[int, ...], list] = {}
    for t in trees:
        stack: list = [(0, {})]
        while stack:
            node, path = stack.pop()
            f = int(t.feature[node])
            if f < 0:
                if path:
                    key = tuple(sorted(path))
                    found.setdefault(key, []).append(([path[k] for k in key], t.weight * float(t.value[node])))
                continue
            thr, (low, high, zero) = float(t.threshold[node]), path.get(f, (-np.inf, np.inf, 1.0))
            lft, rgt = int(t.left[node]), int(t.right[node])
            share = t.cover[lft] / t.cover[node], t.cover[rgt] / t.cover[node]
            stack.append((lft, {**path, f: (low, min(high, thr), zero * share[0])}))
            stack.append((rgt, {**path, f: (max(low, thr), high, zero * share[1])}))
    sets = []
    for key in sorted(found, key=lambda k: (len(k), k)):
        ends = np.array([e for e, _ in found[key]])
        own = LeafSet(key, ends[:, :, 0], ends[:, :, 1], ends[:, :, 2], np.array([v for _, v in found[key]]))
        size, leaves = len(key), len(ends)
        need = 8 * size * leaves << size
        if size <= MOST_FEATURES and need <= table_bytes:
            table_bytes -= need
            bits = [(np.arange(1 << size) >> k & 1).astype(float)[None, :] for k in range(size)]
            step = max(1, CELLS >> size)
            parts = [_shares(own.zero[i:i + step], bits, own.value[i:i + step]) for i in range(0, leaves, step)]
            own.table = np.stack([np.concatenate([p[k] for p in parts]).ravel() for k in range(size)])
        sets.append(own)
    return sets


def shap_batch(sets: Sequence[LeafSet], x: np.ndarray) -> np.ndarray:
    """TreeSHAP for a batch of rows at once (rows x features): one lookup for a row and leaf that has a table."""
    n, m = x.shape
    phi = np.zeros((n, m))
    x = np.clip(x, np.finfo(float).min, np.finfo(float).max)        # -inf lies below every threshold
    for s in sets:
        size, step = len(s.features), max(1, CELLS // max(n, 1))
        columns = [x[:, f, None] for f in s.features]
        for i in range(0, len(s.value), step):
            part = slice(i, i + step)
            follows = [(c > s.low[part, k]) & (c <= s.high[part, k]) for k, c in enumerate(columns)]
            if s.table is None:
                for leaf in range(len(s.value[part])):
                    ones = [f[None, :, leaf].astype(float) for f in follows]
                    at = slice(i + leaf, i + leaf + 1)
                    for f, share in zip(s.features, _shares(s.zero[at], ones, s.value[at])):
                        phi[:, f] += share[0]
                continue
            bits = np.zeros(follows[0].shape, np.uint16)             # at most MOST_FEATURES of them
            for k, f in enumerate(follows):
                bits |= np.left_shift(f, k, dtype=np.uint16)
            case = bits + (np.arange(i, i + bits.shape[1], dtype=np.int64)[None, :] << size)
            for k, f in enumerate(s.features):
                phi[:, f] += s.table[k].take(case).sum(axis=1)
    return phi


def shap_rows(sets: Sequence[LeafSet], x: np.ndarray) -> np.ndarray:
    """:func:`shap_batch`, with rows that lie between the same ends of all leaves worked out once."""
    ends: list[list] = [[np.zeros(0)] for _ in range(x.shape[1])]
    for s in sets:
        for k, f in enumerate(s.features):
            ends[f] += [s.low[:, k], s.high[:, k]]
    if not len(x) or not sets:
        return np.zeros(x.shape)
    first, same = distinct(codes(x, [np.unique(np.concatenate(e)) for e in ends]))
    return shap_batch(sets, x[first])[same] if 2 * len(first) <= len(x) else shap_batch(sets, x)


def tree_expected(t: TreeArrays) -> float:
    leaves = t.feature < 0
    return float((t.value[leaves] * t.cover[leaves]).sum() / t.cover[0])


def tree_sum(trees: Sequence[TreeArrays], x: np.ndarray) -> np.ndarray:
    """The ensemble's own output (margin, or vote) for rows x features, straight from the trees."""
    out, rows = np.zeros(len(x)), np.arange(len(x))
    for t in trees:
        at = np.zeros(len(x), np.int64)
        while (inner := t.feature[at] >= 0).any():
            left = x[rows, np.maximum(t.feature[at], 0)] <= t.threshold[at]
            at = np.where(inner, np.where(left, t.left[at], t.right[at]), at)
        out += t.weight * t.value[at]
    return out


def base_value(trees: Sequence[TreeArrays]) -> float:
    return float(sum(t.weight * tree_expected(t) for t in trees))


# ----------------------------------------------------------------------------- Spark job

def tree_shap(df: DataFrame, model, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus ``phi`` (array, in ``features`` order), ``base_value``
    and ``margin`` (= base_value + sum(phi)) for every row.

    Only the features go through Arrow; the other columns stay where they are.
    """
    spark = df.sparkSession
    tree_model = model.stages[-1] if hasattr(model, "stages") else model
    trees, space = extract_trees(spark, tree_model)
    base = base_value(trees)
    sets = spark.sparkContext.broadcast(leaf_sets(trees))       # TABLE_BYTES, and the leaves themselves

    def explain(rows: pd.DataFrame) -> pd.DataFrame:
        phis = shap_rows(sets.value, rows.fillna(0.0).to_numpy(dtype=float))   # a whole Arrow batch at once
        return pd.DataFrame({"phi": list(phis), "margin": base + phis.sum(axis=1)})

    explained = F.pandas_udf(explain, "phi array<double>, margin double").asNondeterministic()   # once per row
    inputs = F.struct(*[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    kept = [F.col(f"`{c}`") for c in keep]
    return df.select(*kept, explained(inputs).alias("_shap")).select(
        *kept, F.col("_shap.phi").alias("phi"), F.lit(base).alias("base_value"),
        F.col("_shap.margin").alias("margin"), F.lit(space).alias("space"))
