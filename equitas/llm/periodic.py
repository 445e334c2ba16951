"""Operator 13: periodic runs of words, by recursive frequency splitting and a lag scan of what survives.

A run of period q holds at least three periods, so each of its words occurs at
least three times in any segment that contains it. Words below that count in
their current segment split it, the pieces are counted afresh, and so on until
nothing splits any more; a piece shorter than a run can be is dropped. No run is
ever cut, so runs that are maximal in a surviving segment are so in the text.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .handover import only

#: A run is at least LEAST words and PERIODS periods long.
LEAST, PERIODS = 24, 3
#: Windows of this many words tell the periods up to it; doubled windows tell the longer ones.
FIRST_WINDOW = 16

Run = tuple[int, int, int]


def surviving_segments(words: list, least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int]]:
    """Maximal stretches [start, end) of ``least`` words or more in which every word occurs ``periods`` times.

    Of the pieces of a split the longest inherits the counts, less those of the
    rest, and only the rest is counted again, so a word is handled at most
    log(n) times, however a text splits.
    """
    count = Counter(words)
    cuts = [i for i, w in enumerate(words) if count[w] < periods]
    todo, found, where = [(0, len(words), count, cuts)], [], None
    while todo:
        start, end, count, cuts = todo.pop()
        if not cuts:
            if end - start >= least:
                found.append((start, end))
            continue
        edges = [start - 1, *cuts, end]
        pieces = [(a + 1, b) for a, b in zip(edges, edges[1:]) if b - a - 1 >= least]
        if not pieces:
            continue
        heir = max(pieces, key=lambda p: p[1] - p[0])
        rare = set()
        for part in (words[start:heir[0]], words[heir[1]:end]):
            for w, n in Counter(part).items():
                if count[w] >= periods > count[w] - n:
                    rare.add(w)
                count[w] -= n
        if rare and where is None:
            where = {}
            for i, w in enumerate(words):
                where.setdefault(w, []).append(i)
        gone = sorted(i for w in rare for i in where[w][bisect_left(where[w], heir[0]):bisect_left(where[w], heir[1])])
        todo.append((*heir, count, gone))
        for piece in pieces:
            if piece != heir:
                own = Counter(words[piece[0]:piece[1]])
                todo.append((*piece, own, [i for i in range(*piece) if own[words[i]] < periods]))
    return sorted(found)


def candidate_lags(codes: np.ndarray, first: int = FIRST_WINDOW, periods: int = PERIODS) -> list[int]:
    """Lags at which a window of 2^j words recurs first, as every run's period does.

    In a run of smallest period q a window of m words, q <= m <= 2q (or m = 16
    and q <= 16), recurs exactly q words on and not before, else the run had a
    shorter period. Windows are named by doubling, so all lags take O(n log^2 n).
    """
    n, names, size, lags = len(codes), codes, 1, set()
    while size <= first or periods * (size // 2 + 1) <= n:
        if size >= first:
            by = np.argsort(names, kind="stable")
            step = np.diff(by)[np.diff(names[by]) == 0]
            if not len(step):
                break                                              # no longer window recurs either
            lags.update(np.unique(step[(step <= size) & (step > (0 if size == first else size // 2))]).tolist())
        if len(names) <= size:
            break
        pair = names[:-size].astype(np.int64) * (int(names.max()) + 1) + names[size:]
        names, size = np.unique(pair, return_inverse=True)[1], size * 2
    return [q for q in sorted(lags) if periods * q <= n]


def prime_factors(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] * (q > 1)


def scan_segment(codes: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> list[Run]:
    """(start, length, period) of every run of one segment, by comparing it with itself at each candidate lag."""
    runs = []
    for q in candidate_lags(codes, periods=periods):
        same = np.concatenate(([False], codes[:-q] == codes[q:], [False])).astype(np.int8)
        turn = np.diff(same)
        begin, stop = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        for a, b in zip(begin.tolist(), stop.tolist()):
            length = b - a + q
            if length < max(least, periods * q):
                continue
            part = codes[a:a + length]
            if not any(np.array_equal(part[:-(q // p)], part[q // p:]) for p in prime_factors(q)):
                runs.append((a, length, q))
    return runs


def find_runs(words: list) -> list[Run]:
    """(start, length, period) of every run of ``words``, by start, then period."""
    runs = []
    for start, end in surviving_segments(words):
        codes = pd.factorize(pd.Series(words[start:end], dtype=object))[0]
        runs += [(start + a, length, q) for a, length, q in scan_segment(codes)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period (exact); ties: smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, runs: list[Run]) -> list:
    """``words`` without those that a run contains after its first period."""
    if not runs:
        return words
    turn = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        turn[start + q] += 1
        turn[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(turn).tolist()) if not n]


def plant_tail(words: list, h: int) -> list:
    """``words`` with a periodic tail, where ``h`` asks for one (h % 10 = 0)."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


RESULT = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>")


def describe(text: str | None, h: int | None = None) -> tuple:
    """The columns of RESULT for one whole text (null: empty); ``h`` plants a tail first."""
    words = (text or "").encode().split()                        # bytes split at exactly x20 and x09 to x0D
    words = plant_tail(words, h) if h is not None else words
    runs = find_runs(words)
    best = strongest(runs)
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    left = b" ".join(collapsed(words, runs))
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest(), runs)


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, the run columns and the list of ``runs`` for every row of ``docs``, over its whole text.

    ``plant`` writes the test tails first, by crc32 of the id as decimal text
    (null id: of ''). A null, empty or blank text has no words and no run.
    Repeated rows are each returned; an empty table gives no rows; further
    columns are ignored. One text is the work of one task, O(n log^2 n) in its
    words besides one comparison per candidate lag.
    """
    def run(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        names = [f.split()[0] for f in RESULT.split(", runs ")[0].split(", ")] + ["runs"]
        rows = [describe(t, zlib.crc32(i.encode()) if plant else None) for i, t in zip(ids, texts)]
        out = pd.DataFrame(rows, columns=names)
        for c in names[1:5]:
            out[c] = out[c].astype("Int64")
        out["runs"] = [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in out["runs"]]
        return out

    udf = F.pandas_udf(run, RESULT).asNondeterministic()
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return only(docs, "doc_id", "text").select("doc_id", udf(key, "text").alias("found")).select("doc_id", "found.*")
