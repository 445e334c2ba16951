"""Operator 3: toxicity by weak supervision (voters, a generative label model, a linear classifier)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .handover import handover, held_out, only

#: Labelled documents that lexicons, label model and classifier are fitted on, about.
FIT_DOCS = 16_000
#: Terms (words and word beginnings) the classifier sees, and how many of them vote on their own.
MOST_TERMS, TERM_VOTERS = 600, 60
#: A term counts from so many documents and so many standard errors on.
LEAST_DOCS, LEAST_Z = 4, 3.0
#: Lengths of the word beginnings that are terms besides whole words.
STEMS = (4, 5, 6)

# Small public word lists by kind of abuse.
LEXICONS = {
    "insult": "idiot idiots moron morons stupid dumb fool imbecile retard dimwit jerk clown loser losers",
    "contempt": "pathetic worthless disgusting useless ridiculous contemptible despicable repulsive",
    "dehumanising": "scum trash vermin filth garbage parasite parasites subhuman animals pigs rats",
    "threat": "kill die hurt destroy strangle shoot stab murder",
    "profanity": "damn crap hell bastard bastards bitch shit fuck fucking asshole",
    "insult_de": "idiot dummkopf trottel depp arschloch abschaum versager ekelhaft erbärmlich wertlos",
    "insult_fr": "idiot imbécile crétin connard salaud ordure minable dégoûtant pathétique merde",
    "insult_es": "idiota imbécil estúpido estúpida basura escoria patético asqueroso mierda payaso",
}
# Patterns on the raw text.
PATTERNS = {
    "second_person": r"(?i)\b(?:you|du|tu|usted|vous)\b[^.!?\n]{0,20}\b(?:idiot|moron|stupid|loser|scum|trash|clown)",
    "shouting": r"(?:\b[A-Z]{3,}\b[ ,!]+){3}",
    "exclaiming": r"!{3,}",
    "masked": r"\b[A-Za-z]+\*{2,}[A-Za-z]+\b",
    "spelled_out": r"\b(?:[A-Za-z]-){4,}[A-Za-z]\b",
}
WORD_SETS = {k: frozenset(v.split()) for k, v in LEXICONS.items()}
COMPILED = {k: re.compile(v) for k, v in PATTERNS.items()}
FIXED = [*WORD_SETS, *COMPILED, "many_hits"]
ALL_WORDS = frozenset().union(*WORD_SETS.values())
LETTERS = re.compile(r"[^\W\d_]+")


def term_column(text):
    """Distinct terms of a text as an array column: whole words, and beginnings of longer ones."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1)))
    stems = [F.transform(F.filter(words, lambda w, n=n: F.length(w) > n),
                         lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("-"))) for n in STEMS]
    return F.array_distinct(F.concat(words, *stems))


def terms_of(words: set[str], wanted: dict[str, int]) -> set[int]:
    """Places in ``wanted`` of the terms among ``words``, as ``term_column`` has them."""
    found = {wanted[w] for w in words & wanted.keys()}
    for n in STEMS:
        found.update(wanted[s] for s in {w[:n] + "-" for w in words if len(w) > n} & wanted.keys())
    return found


def fixed_votes(text: str, words: set[str], line: list[str]) -> list[int]:
    """Which of the fixed voters fire, as places in FIXED."""
    hits = words & ALL_WORDS
    fired = [i for i, own in enumerate(WORD_SETS.values()) if hits and hits & own]
    n = len(WORD_SETS)
    fired += [n + i for i, p in enumerate(COMPILED.values()) if p.search(text)]
    if hits and sum(w in ALL_WORDS for w in line) >= 2:
        fired.append(len(FIXED) - 1)
    return fired


def features(text: str | None, wanted: dict[str, int]) -> list[int]:
    """Places of a whole text's features: fixed voters first, then terms."""
    text = text or ""
    line = LETTERS.findall(text.lower())
    words = set(line)
    return fixed_votes(text, words, line) + sorted(len(FIXED) + i for i in terms_of(words, wanted))


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, dict]:
    """Posterior of the hidden label, from votes (rows x voters, 0/1) and the noisy given labels.

    A generative model: the hidden label y has a prior; voter j fires with
    probability a_j if y = 1 and b_j if y = 0 (its accuracies); the given label
    is one more voter with accuracies of its own. Voters correlate beyond y: from
    the residuals given y comes a correlation matrix, and each voter counts by
    the inverse of its summed positive correlations, so copies of one voter
    weigh like one. EM starts from the given labels.
    """
    q = np.clip(gold.astype(float), 0.02, 0.98)
    n = len(q)
    weight = np.ones(votes.shape[1])
    both = np.column_stack([votes, gold]).astype(float)
    for _ in range(rounds):
        up, down = q.sum() + 1e-9, n - q.sum() + 1e-9
        fire1 = np.clip((q @ both + 0.1) / (up + 1), 1e-5, 1 - 1e-5)
        fire0 = np.clip(((1 - q) @ both + 0.1) / (down + 1), 1e-5, 1 - 1e-5)
        mean = q[:, None] * fire1[None, :-1] + (1 - q)[:, None] * fire0[None, :-1]
        rest = votes - mean
        scale = np.sqrt((rest * rest).mean(axis=0)) + 1e-6
        corr = (rest.T @ rest) / n / np.outer(scale, scale)
        weight = 1 / np.maximum(1.0, np.where(corr > 0.1, corr, 0).sum(axis=1))
        each = np.append(weight, 1.0)
        logit = (np.log(up / down) + both @ (each * np.log(fire1 / fire0))
                 + (1 - both) @ (each * np.log((1 - fire1) / (1 - fire0))))
        new = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        if np.abs(new - q).max() < 1e-4:
            q = new
            break
        q = new
    return q, {"fires_if_toxic": fire1, "fires_if_clean": fire0, "weight": weight, "correlation": corr}


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.5, rounds: int = 400) -> np.ndarray:
    """Logistic regression on soft labels by accelerated full-batch descent; last weight: intercept.

    Both labels weigh alike in the loss, whatever their shares.
    """
    n, d = x.shape
    w = np.zeros(d + 1)
    base = target.mean().clip(1e-3, 1 - 1e-3)
    cost = target / (2 * base) + (1 - target) / (2 * (1 - base))
    step = 4.0 / max(1.0, float((cost * (x.sum(axis=1) + 1)).mean()) * 2)
    move, v = w.copy(), w.copy()
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v[:-1] + v[-1], -40, 40)))
        gap = cost * (p - target)
        grad = np.append(x.T @ gap / n + ridge / n * v[:-1], gap.mean())
        new = v - step * grad
        v = new + t / (t + 3) * (new - move)
        move = new
    return move


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, where=None) -> tuple[list[str], np.ndarray]:
    """(terms, weights) learned from labelled documents; ``where`` restricts them.

    About ``fit_docs`` labelled documents, those of smallest hash, are kept with
    their texts. Terms whose share of toxic documents stands out by LEAST_Z
    standard errors are found by one aggregation; a second pass gives each
    document's features, and only those come to the driver.
    """
    known = (only(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y")))
    known = known.where(where) if where is not None else known
    total = known.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1 << 30))
    known = known.where(draw < int((1 << 30) * min(1.0, fit_docs / max(1, total))))
    sample = handover(only(docs, "doc_id", "text").where("text is not null").join(known, "doc_id")
                      .select("doc_id", "text", "y"), "toxic-sample")
    n, up = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or not up or up == n:
        return [], np.append(np.zeros(len(FIXED)), 40.0 * (bool(up) - 0.5))
    share = up / n
    counted = (sample.select(F.explode(term_column(F.col("text"))).alias("term"), "y").groupBy("term")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("up")).where(F.col("n") >= LEAST_DOCS))
    z = (F.col("up") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1)
    top = counted.withColumn("z", z).where(F.abs("z") >= LEAST_Z).orderBy(F.desc(F.abs("z")), "term").limit(MOST_TERMS)
    picked = top.select("term", "z").collect()                    # at most MOST_TERMS rows
    terms = [r["term"] for r in picked]
    wanted = {t: i for i, t in enumerate(terms)}

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["doc_id"].astype(str), "y": batch["y"],
                                "at": [features(t, wanted) for t in batch["text"]]})

    got = sample.mapInPandas(describe, "id string, y int, at array<int>").toPandas().sort_values("id")
    x = np.zeros((len(got), len(FIXED) + len(terms)), np.float32)
    for i, at in enumerate(got["at"]):
        x[i, np.asarray(at, dtype=np.int64)] = 1
    voting = [len(FIXED) + i for i, r in enumerate(picked) if r["z"] > 0][:TERM_VOTERS]
    posterior, _ = label_model(x[:, [*range(len(FIXED)), *voting]].astype(float), got["y"].to_numpy())
    return terms, fit_linear(x.astype(float), posterior)


def score(docs: DataFrame, terms: list[str], weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from the whole text alone (null as empty)."""
    wanted = {t: i for i, t in enumerate(terms)}                   # at most MOST_TERMS

    def run(texts: pd.Series) -> pd.Series:
        logit = np.array([weights[-1] + weights[features(t, wanted)].sum() for t in texts], dtype=float)
        return pd.Series(1 / (1 + np.exp(-np.clip(logit, -40, 40))))

    rate = F.pandas_udf(run, "double").asNondeterministic()
    return only(docs, "doc_id", "text").select("doc_id", rate("text").alias("score")).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def rate_toxicity(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """Score every document; learn only outside the held-out fold.

    Learned from: rows whose crc32(doc_id as text) mod 5 is not 0, with a text
    and a non-null label (of several labels for an id the largest). Inputs of a
    score are the text's words and patterns only. Without labels of both kinds
    every score is that of the one kind (no label at all: near 0). Null and
    empty texts score the intercept. Repeated rows are each returned; an empty
    table gives no rows; further columns of either table are ignored.
    """
    terms, weights = fit(docs, labels, fit_docs, ~held_out())
    return score(docs, terms, weights)
