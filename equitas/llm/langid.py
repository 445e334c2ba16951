"""Operator 2: language by multilingual mixture inference (EM over n-gram likelihoods)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .handover import columns_of, fresh, held_out, only

#: Hashed character trigrams per language.
BUCKETS = 1 << 16
#: Documents that each language is learned from, about (those of smallest hash).
FIT_DOCS = 3000
#: Distinct values of ``lang`` that can be learned; more are refused as a column that is not a language.
MOST_LEARNED = 256
#: Least share of the predicted language in a document that ``keep_identified`` keeps.
LEAST_SHARE = 0.5
#: Words times languages that EM holds at a time.
CELLS_AT_ONCE = 1 << 21
#: Words whose likelihoods a task remembers.
WORDS_KEPT = 400_000
#: Additive smoothing of trigram counts.
SMOOTH = 0.2

LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return LETTERS.findall(text.lower()) if text else []


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all words, each word between blanks, and where each word's begin."""
    line = " " + "  ".join(words) + " "
    code = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 2) - (sizes + 2)      # the blank before each word; a word has as many trigrams as letters
    mixed = (code[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
             ^ code[2:] * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    hashed = (mixed >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    inside = np.ones(len(hashed), bool)
    ends = starts + sizes                            # the last trigram of a word ends on its closing blank
    inside[ends[ends < len(hashed)]] = False
    inside[ends[ends + 1 < len(hashed)] + 1] = False
    return hashed[inside], np.cumsum(sizes) - sizes


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, where=None) -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihood of each hashed trigram by language) from text and lang.

    Of every language about ``fit_docs`` labelled documents are read, chosen by
    the hash of the id; tasks count trigrams, and only the counts meet. A column
    of more than MOST_LEARNED values raises ValueError.
    """
    rows = only(docs, "doc_id", "text", "lang").where("lang is not null and text is not null")
    rows = rows.where(where) if where is not None else rows
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MOST_LEARNED + 1).collect()}
    if len(sizes) > MOST_LEARNED:
        raise ValueError(f"lang has more than {MOST_LEARNED} values")
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    quota = F.create_map(*(F.lit(x) for k in langs for x in (k, min(1.0, fit_docs / sizes[k]))))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("langid")),
                  F.lit(1 << 30)) / F.lit(float(1 << 30))
    place = {k: i for i, k in enumerate(langs)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((len(langs), BUCKETS), np.int64)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                words = words_of(text)
                if words:
                    table[place[lang]] += np.bincount(trigrams(words)[0], minlength=BUCKETS)
        k, b = np.nonzero(table)
        yield pd.DataFrame({"k": k.astype(np.int32), "b": b.astype(np.int32), "n": table[k, b]})

    # at most languages x BUCKETS rows
    got = (rows.where(draw < quota[F.col("lang")]).select("lang", "text")
           .mapInPandas(count, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n")).toPandas())
    table = np.full((BUCKETS, len(langs)), SMOOTH)
    np.add.at(table, (got["b"].to_numpy(), got["k"].to_numpy()), got["n"].to_numpy())
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def mixture(like: np.ndarray, counts: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM for all documents at once: proportions by language, and log-likelihood.

    ``like`` (languages x words) has each word's likelihood by language, the
    words of the documents one after another, ``counts`` of them each;
    ``share`` (languages x documents) is the start, in which 0 stays 0.
    """
    starts = np.cumsum(counts) - counts
    for _ in range(rounds):
        part = np.repeat(share, counts, axis=1)
        part *= like
        part /= part.sum(axis=0)
        share = np.add.reduceat(part, starts, axis=1) / counts
    whole = (np.repeat(share, counts, axis=1) * like).sum(axis=0)
    return share, np.add.reduceat(np.log(whole, dtype=np.float64), starts)


def highest_value(like: np.ndarray, counts: np.ndarray, share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A log-likelihood that no proportions whatever exceed, per document.

    The log-likelihood is concave in the proportions, so it lies below its
    tangent at ``share``, which is highest at one language alone.
    """
    whole = (np.repeat(share, counts, axis=1) * like).sum(axis=0)
    slope = np.add.reduceat(like / whole, np.cumsum(counts) - counts, axis=1, dtype=np.float64)
    return value + slope.max(axis=0) - counts


def select_languages(like: np.ndarray, counts: np.ndarray, most: int | None = None,
                     rounds: int = 8) -> np.ndarray:
    """Proportions (languages x documents) under the set of highest penalised likelihood.

    Sets are nested: the languages of largest proportion in the mixture of all.
    A set of s languages pays log(words) / 2 for every one but the first, and
    the best of all sizes (up to ``most``, if given) is chosen, the smaller of
    equal ones. A size is passed over only where even the highest likelihood
    that any proportions can have would not pay for it.
    """
    k, n = like.shape[0], len(counts)
    full, value = mixture(like, counts, np.full((k, n), 1 / k, like.dtype), rounds)
    limit = highest_value(like, counts, full, value) + 1e-2           # float32 sums
    rank = np.argsort(np.argsort(-full, axis=0, kind="stable"), axis=0, kind="stable")
    doc = np.repeat(np.arange(n), counts)
    fee = 0.5 * np.log(np.maximum(counts, 2))
    best, chosen = np.full(n, -np.inf), np.where(rank == 0, 1, 0).astype(like.dtype)
    for size in range(1, min(most or k, k) + 1):
        open_ = np.flatnonzero(limit - (size - 1) * fee > best + 1e-6)
        if not len(open_):
            break
        words = np.isin(doc, open_) if len(open_) < n else slice(None)
        start = np.where(rank[:, open_] < size, np.maximum(full[:, open_], 1e-3), 0)
        share, value = mixture(like[:, words], counts[open_], start / start.sum(axis=0), rounds * (size > 1))
        value = value - (size - 1) * fee[open_]
        better = value > best[open_] + 1e-6
        best[open_[better]], chosen[:, open_[better]] = value[better], share[:, better]
    return chosen


def predictor(spark: SparkSession, langs: list[str], table: np.ndarray, most: int | None = None):
    """A column function from text to (lang_pred, score, letters, languages); see ``predict``."""
    model = spark.sparkContext.broadcast((langs, table))      # languages x BUCKETS floats, fixed by the fit

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, loglike = model.value
        k = max(1, len(names))
        known: dict[str, int] = {}
        likes = np.zeros((1024, k), np.float32)

        def learn(new: list[str]) -> None:
            nonlocal likes
            grams, at = trigrams(new)
            value = np.add.reduceat(loglike[grams], at, axis=0)
            value = np.exp(np.maximum(value - value.max(axis=1, keepdims=True), -60))
            first = len(known)
            if first + len(new) > len(likes):
                likes = np.concatenate([likes, np.zeros((max(len(likes), len(new)), k), np.float32)])
            likes[first:first + len(new)] = value
            known.update(zip(new, range(first, first + len(new))))

        def infer(part: list[list[str]]) -> np.ndarray:
            if len(known) > WORDS_KEPT:
                known.clear()
            seen = [w for words in part for w in words]
            new = [w for w in dict.fromkeys(seen) if w not in known]
            if new:
                learn(new)
            which = np.fromiter(map(known.__getitem__, seen), np.int64, len(seen))
            counts = np.fromiter(map(len, part), np.int64, len(part))
            return select_languages(np.ascontiguousarray(likes[which].T), counts, most).T

        for texts in columns:
            n = len(texts)
            lang, score = np.full(n, "und", object), np.zeros(n)
            letters = np.zeros(n, bool)
            sets: list[dict] = [{} for _ in range(n)]
            held: list[tuple[int, list[str]]] = []
            size = 0

            def flush() -> None:
                nonlocal size
                if not held:
                    return
                share = infer([w for _, w in held])
                top = share.argmax(axis=1)
                for j, (i, _) in enumerate(held):
                    lang[i], score[i] = names[top[j]], min(1.0, float(share[j, top[j]]))
                    sets[i] = {names[c]: float(share[j, c]) for c in np.flatnonzero(share[j] > 0)}
                held.clear()
                size = 0

            for i, text in enumerate(texts):
                words = words_of(text)
                letters[i] = any(c.isalpha() for w in words for c in w)
                if letters[i] and names:
                    held.append((i, words))
                    size += len(words) * k
                    if size >= CELLS_AT_ONCE:
                        flush()
            flush()
            yield pd.DataFrame({"lang_pred": lang, "score": score, "letters": letters, "languages": sets})

    kind = "lang_pred string, score double, letters boolean, languages map<string,double>"
    # once per row, whatever reads its fields
    return F.pandas_udf(run, kind).asNondeterministic()


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, most: int | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages (the chosen set with proportions) of every row.

    The score is the proportion of the predicted language among the words.
    Texts that are null or without a letter are 'und' with score 0 and an empty
    set; so is every text if nothing was learned. A text of any length is
    inferred whole. Ties go to the language first in order.
    """
    guess = predictor(docs.sparkSession, langs, table, most)
    return only(docs, "doc_id", "text").select("doc_id", guess("text").alias("p")).select(
        "doc_id", held_out().alias("held_out"), "p.lang_pred", "p.score", "p.languages")


def identify(docs: DataFrame, fit_docs: int = FIT_DOCS, most: int | None = None) -> DataFrame:
    """Predict every document's language; learn only outside the held-out fold.

    Learned from: text and non-null lang of rows whose crc32(doc_id as text) mod
    5 is not 0. See ``predict`` for the result and its edge cases. Repeated rows
    are each returned; an empty table gives no rows; further columns are ignored.
    """
    langs, table = fit(docs, fit_docs, ~held_out())
    return predict(docs, langs, table, most)


def keep_identified(docs: DataFrame, fit_docs: int = FIT_DOCS, wanted: list[str] | None = None,
                    least: float = LEAST_SHARE) -> DataFrame:
    """The documents whose mixture has a wanted language, with all their columns.

    A document stays if its predicted language is one of ``wanted`` (None: any
    learned) with a share of at least ``least`` of its words. Those without a
    letter go, and those of so many languages that none has that share. Where
    nothing can be learned, all documents with letters stay.
    """
    langs, table = fit(docs, fit_docs, ~held_out())
    guess = predictor(docs.sparkSession, langs, table)
    name = fresh(docs, "_language")
    seen = docs.withColumn(name, guess("text"))
    known = (F.col(f"{name}.lang_pred") != "und") & (F.col(f"{name}.score") >= least)
    if wanted is not None:
        known &= F.col(f"{name}.lang_pred").isin(list(wanted))
    return seen.where(known if langs else F.col(f"{name}.letters")).select(*columns_of(docs))
