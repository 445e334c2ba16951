"""The published path-dependent recursion for one row, which the batch form is tested against."""

from __future__ import annotations

import numpy as np


def _extend(path, pz, po, pi):
    depth = len(path)
    path.append([pi, pz, po, 1.0 if depth == 0 else 0.0])
    for i in range(depth - 1, -1, -1):
        path[i + 1][3] += po * path[i][3] * (i + 1) / (depth + 1)
        path[i][3] = pz * path[i][3] * (depth - i) / (depth + 1)


def _unwind(path, idx):
    depth = len(path) - 1
    po, pz = path[idx][2], path[idx][1]
    nxt = path[depth][3]
    for i in range(depth - 1, -1, -1):
        if po != 0:
            tmp = path[i][3]
            path[i][3] = nxt * (depth + 1) / ((i + 1) * po)
            nxt = tmp - path[i][3] * pz * (depth - i) / (depth + 1)
        else:
            path[i][3] = path[i][3] * (depth + 1) / (pz * (depth - i))
    for i in range(idx, depth):
        path[i][0], path[i][1], path[i][2] = path[i + 1][0], path[i + 1][1], path[i + 1][2]
    path.pop()


def _unwound_sum(path, idx):
    depth = len(path) - 1
    po, pz = path[idx][2], path[idx][1]
    nxt = path[depth][3]
    total = 0.0
    for i in range(depth - 1, -1, -1):
        if po != 0:
            tmp = nxt * (depth + 1) / ((i + 1) * po)
            total += tmp
            nxt = path[i][3] - tmp * pz * (depth - i) / (depth + 1)
        else:
            total += path[i][3] / pz / ((depth - i) / (depth + 1))
    return total


def _recurse(t, x, phi, node, path, pz, po, pi):
    path = [p[:] for p in path]
    _extend(path, pz, po, pi)
    if t.feature[node] < 0:
        v = t.value[node]
        for i in range(1, len(path)):
            w = _unwound_sum(path, i)
            phi[path[i][0]] += w * (path[i][2] - path[i][1]) * v
        return
    f = t.feature[node]
    go_left = x[f] <= t.threshold[node]
    hot, cold = (t.left[node], t.right[node]) if go_left else (t.right[node], t.left[node])
    iz = io = 1.0
    k = next((i for i in range(1, len(path)) if path[i][0] == f), None)
    if k is not None:
        iz, io = path[k][1], path[k][2]
        _unwind(path, k)
    c = t.cover[node]
    _recurse(t, x, phi, hot, path, iz * t.cover[hot] / c, io, f)
    _recurse(t, x, phi, cold, path, iz * t.cover[cold] / c, 0.0, f)


def shap_row(trees, x, n_features: int) -> np.ndarray:
    phi = np.zeros(n_features)
    for t in trees:
        part = np.zeros(n_features)
        _recurse(t, x, part, 0, [], 1.0, 1.0, -1)
        phi += t.weight * part
    return phi
