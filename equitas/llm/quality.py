"""Operator 12: document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line is described by its own figures and those of
the lines before and after it, each cut into bins; neighbouring labels are tied
by transition weights. Forward-backward gives every line's probability of being
good, and a document's score is their mean, weighted by the length of the lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .handover import held_out, only

#: Labelled documents the field is fitted on, about, and the most lines of one of them (from a random place on).
FIT_DOCS, FIT_LINES = 8_000, 400
#: Bins per figure, and one more where there is no line before or after.
BINS = 8
#: Characters whose figures are taken at once.
CHUNK = 2_000_000

# Character classes.
LOWER, UPPER, DIGIT, SPACE, MARK, SYMBOL = range(6)
# Marks of ordinary prose.
MARKS = ".,;:!?'\"()-"
ENDS = (".", "!", "?", ":", '."', '!"', '?"')
FIGURES = ("length", "upper", "letters", "digits", "marks", "symbols", "spaces", "words", "word_length", "ends",
           "starts", "variety", "stutter", "seen", "longest_word", "exclaims")
PLACES = 3 * len(FIGURES)


def _classes(upto: int = 0x3000) -> np.ndarray:
    """Class of each code point below ``upto``; those above count as letters."""
    def kind(c: str) -> int:
        if c.isspace():
            return SPACE
        if c.isalpha():
            return UPPER if c.isupper() else LOWER
        return DIGIT if c.isdigit() else MARK if c in MARKS else SYMBOL
    return np.array([kind(chr(i)) for i in range(upto)], np.int8)


CLASS = _classes()


def line_figures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(figures of all lines of all texts, lines per text, characters per line)."""
    split = [t.split("\n") for t in texts]
    lines = [x for s in split for x in s]
    per_text = np.array([len(s) for s in split], np.int64)
    size = np.array([len(x) for x in lines], np.int64)
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.where(codes < len(CLASS), CLASS[np.minimum(codes, len(CLASS) - 1)], LOWER)
    first = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    share = {k: np.add.reduceat((kinds == k).astype(np.int64), first) for k in range(SPACE)}
    share[SPACE] = np.add.reduceat((kinds == SPACE).astype(np.int64), first) - 1       # less the line's own end
    share |= {k: np.add.reduceat((kinds == k).astype(np.int64), first) for k in (MARK, SYMBOL)}
    out = np.zeros((len(lines), len(FIGURES)), np.float32)
    full = np.maximum(size, 1)
    letters = share[LOWER] + share[UPPER]
    out[:, 0] = np.log1p(size)
    out[:, 1] = share[UPPER] / np.maximum(letters, 1)
    out[:, 2], out[:, 3], out[:, 4] = letters / full, share[DIGIT] / full, share[MARK] / full
    out[:, 5], out[:, 6] = share[SYMBOL] / full, share[SPACE] / full
    at = 0
    for s in split:
        before: set[str] = set()
        for line in s:
            words = line.split()
            n = len(words)
            row = out[at]
            if n:
                row[7], row[8] = np.log1p(n), (len(line) - n + 1) / n
                row[9], row[10] = line.rstrip().endswith(ENDS), words[0][0].isupper()
                row[11] = len(set(words)) / n
                row[12] = sum(map(str.__eq__, words, words[1:])) / n
                row[13] = line in before
                row[14] = max(map(len, words))
                row[15] = line.count("!") / n
                before.add(line)
            at += 1
    return out, per_text, size


def bin_edges(figures: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Quantile edges of every figure, of which equal ones simply leave bins empty."""
    return np.quantile(figures, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T


def places(figures: np.ndarray, per_text: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Places of each line's weights: its own bins, then those of the line before and after."""
    n, bins = len(figures), edges.shape[1] + 1
    # halves tell a value that equals an edge many times over from those on either side
    own = np.column_stack([np.searchsorted(e, figures[:, j], "left") + np.searchsorted(e, figures[:, j], "right")
                           for j, e in enumerate(edges)]) if n else np.zeros((0, len(edges)), int)
    width = 2 * bins
    none = np.full((1, len(edges)), width - 1)
    start = np.concatenate(([0], np.cumsum(per_text)))
    before, after = np.concatenate((none, own[:-1])), np.concatenate((own[1:], none))
    before[start[:-1]], after[start[1:] - 1] = none, none
    return np.concatenate((own, before, after), axis=1) + np.arange(3 * len(edges)) * width


class Field:
    """Weights of the field: ``line`` by place, one ``bias``, ``edge[y, z]`` from label y to z, ``begin[y]``."""

    def __init__(self, edges: np.ndarray, flat: np.ndarray | None = None):
        self.edges = edges
        self.size = PLACES * 2 * (edges.shape[1] + 1)
        self.flat = np.zeros(self.size + 7) if flat is None else flat

    @property
    def line(self) -> np.ndarray:
        return self.flat[:self.size]

    def emissions(self, at: np.ndarray) -> np.ndarray:
        """Score of a line's being good rather than bad."""
        return self.line[at].sum(axis=1) + self.flat[self.size]

    def chain(self) -> tuple[np.ndarray, np.ndarray]:
        return self.flat[self.size + 1:self.size + 5].reshape(2, 2), self.flat[self.size + 5:]


def forward_backward(emit: np.ndarray, per_text: np.ndarray, edge: np.ndarray, begin: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(P(line good), log Z of each text, expected transition counts), all texts side by side."""
    order = np.argsort(-per_text, kind="stable")
    start = np.concatenate(([0], np.cumsum(per_text)))[:-1][order]
    length = per_text[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), "left")   # texts with more than t lines
    score = np.column_stack((np.zeros(len(emit)), emit))
    alpha, beta = np.zeros((len(emit), 2)), np.zeros((len(emit), 2))
    for t in range(longest):
        at = start[:active[t]] + t
        if t == 0:
            alpha[at] = begin + score[at]
        else:
            before = alpha[at - 1]
            alpha[at] = np.logaddexp(before[:, :1] + edge[0], before[:, 1:] + edge[1]) + score[at]
    for t in range(longest - 2, -1, -1):
        at = start[:active[t + 1]] + t
        after = beta[at + 1] + score[at + 1]
        beta[at] = np.logaddexp(edge[:, 0] + after[:, :1], edge[:, 1] + after[:, 1:])
    log_z = np.zeros(len(per_text))
    log_z[order] = np.logaddexp(*alpha[start + length - 1].T)
    z = np.repeat(log_z, per_text)
    good = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - z, 0))
    tail = np.ones(len(emit), bool)
    tail[np.cumsum(per_text) - 1] = False
    i = np.flatnonzero(tail)
    pair = alpha[i][:, :, None] + edge + (score[i + 1] + beta[i + 1])[:, None, :] - z[i][:, None, None]
    return good, log_z, np.exp(np.minimum(pair, 0)).sum(axis=0)


def likelihood(field: Field, at: np.ndarray, per_text: np.ndarray, labels: np.ndarray, ridge: float
               ) -> tuple[float, np.ndarray]:
    """Mean log likelihood of the line labels a text, less the ridge, and its gradient."""
    edge, begin = field.chain()
    emit = field.emissions(at)
    good, log_z, expected = forward_backward(emit, per_text, edge, begin)
    first = np.concatenate(([0], np.cumsum(per_text)))[:-1]
    inner = np.ones(len(labels), bool)
    inner[first] = False
    i = np.flatnonzero(inner)
    seen = np.bincount(2 * labels[i - 1] + labels[i], minlength=4).reshape(2, 2)
    n = len(per_text)
    value = (emit @ labels + (seen * edge).sum() + begin[labels[first]].sum() - log_z.sum()) / n
    rest = labels - good
    grad = np.zeros_like(field.flat)
    grad[:field.size] = np.bincount(at.ravel(), np.repeat(rest, at.shape[1]), field.size)
    grad[field.size] = rest.sum()
    grad[field.size + 1:field.size + 5] = (seen - expected).ravel()
    up = good[first].sum()
    grad[field.size + 5:] = np.bincount(labels[first], minlength=2) - np.array([n - up, up])
    return value - ridge / 2 * field.flat @ field.flat, grad / n - ridge * field.flat


def train(figures: np.ndarray, per_text: np.ndarray, labels: np.ndarray, rounds: int = 120, rate: float = 0.08,
          ridge: float = 1e-3) -> Field:
    """The field that makes the line labels likely (Adam on the whole sample)."""
    field = Field(bin_edges(figures))
    at = places(figures, per_text, field.edges)
    one, two = np.zeros_like(field.flat), np.zeros_like(field.flat)
    for t in range(1, rounds + 1):
        _, grad = likelihood(field, at, per_text, labels, ridge)
        one, two = 0.9 * one + 0.1 * grad, 0.99 * two + 0.01 * grad * grad
        field.flat = field.flat + rate * (one / (1 - 0.9 ** t)) / (np.sqrt(two / (1 - 0.99 ** t)) + 1e-8)
    return field


def marginals(field: Field, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(P(good) of all lines, lines per text, characters per line)."""
    figures, per_text, size = line_figures(texts)
    edge, begin = field.chain()
    good, _, _ = forward_backward(field.emissions(places(figures, per_text, field.edges)), per_text, edge, begin)
    return good, per_text, size


def quality(field: Field, texts: list[str]) -> np.ndarray:
    """Length-weighted mean of the lines' marginals, per text."""
    good, per_text, size = marginals(field, texts)
    first = np.concatenate(([0], np.cumsum(per_text)))[:-1]
    weight = size + 1.0
    return np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)


def chunks(texts: pd.Series, most: int = CHUNK) -> Iterator[list[str]]:
    """Whole texts, some ``most`` characters at a time (a longer text on its own)."""
    part, held = [], 0
    for t in texts:
        t = t or ""
        if part and held + len(t) > most:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, where=None) -> Field | float:
    """The field learned from labelled documents; the plain share of label 1 if only one label occurs.

    About ``fit_docs`` labelled documents, those of smallest hash, are described
    line by line; of a text of more than FIT_LINES lines so many, from a place
    its id gives, are learned from. Every line carries its document's label.
    """
    known = (only(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.max(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("y")))
    known = known.where(where) if where is not None else known
    total = known.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality")), F.lit(1 << 30))
    known = known.where(draw < int((1 << 30) * min(1.0, fit_docs / max(1, total))))
    sample = only(docs, "doc_id", "text").where("text is not null").join(known, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"), "text", "y", draw.alias("draw"))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text, draw in zip(batch["text"], batch["draw"]):
                lines = text.split("\n")
                skip = int(draw) % (len(lines) - FIT_LINES + 1) if len(lines) > FIT_LINES else 0
                found.append(line_figures(["\n".join(lines[skip:skip + FIT_LINES])])[0].ravel().tolist())
            yield pd.DataFrame({"id": batch["id"], "y": batch["y"], "figures": found})

    got = sample.mapInPandas(describe, "id string, y int, figures array<float>").toPandas()
    if got["y"].nunique() < 2:
        return float(got["y"].mean()) if len(got) else 1.0
    got = got.sort_values(["id", "y"]).reset_index(drop=True)
    per_text = got["figures"].map(len).to_numpy() // len(FIGURES)
    figures = np.concatenate(got["figures"].map(np.asarray).to_list()).reshape(-1, len(FIGURES))
    return train(figures, per_text, np.repeat(got["y"].to_numpy().astype(int), per_text))


def score(docs: DataFrame, field: Field | float) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from the whole text alone (null as empty)."""
    edges, flat = (field.edges, field.flat) if isinstance(field, Field) else (None, field)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Field(edges, flat) if edges is not None else None
        for texts in batches:
            if model is None:
                yield pd.Series(np.full(len(texts), flat))
            else:
                yield pd.Series(np.concatenate([quality(model, part) for part in chunks(texts)] or [np.zeros(0)]))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    rate = F.pandas_udf(run, "double").asNondeterministic()
    return only(docs, "doc_id", "text").select("doc_id", rate("text").alias("score")).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def rate_quality(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """Score every document; learn only outside the held-out fold.

    Learned from: rows whose crc32(doc_id as text) mod 5 is not 0, with a text
    and a non-null label (of several labels for an id the largest). Inputs of a
    score are the lines of the text only. If only one label occurs every score
    is that label's share (no label at all: 1). Null and empty texts are one
    blank line. Repeated rows are each returned; an empty table gives no rows;
    further columns of either table are ignored.
    """
    return score(docs, fit(docs, labels, fit_docs, ~held_out()))
