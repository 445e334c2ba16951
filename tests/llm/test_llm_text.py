"""The other operators: brute force, exact round trips, held-out accuracy."""

import glob
import hashlib
import math
import os
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from equitas.llm import embeddings, langid, pieces, pii, simhash, tokens, toxicity
from equitas.llm.components import Forest, components
from conftest_llm import ODD, ODD_SCHEMA, fold

SF = "/root/testdata/sf0.001"


def closed(n, links):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(300, 360)]
    links += [(400, i) for i in range(401, 480)]
    want = closed(480, links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(want[n] == c for n, c in got.items())
    assert all(n in got for a, b in links if a != b for n in (a, b))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    rng = np.random.default_rng(6)
    links = rng.integers(0, 200, (150, 2))
    forest = Forest(200)
    for part in np.array_split(links, 7):
        forest.union(part[:, 0], part[:, 1])
    assert forest.roots().tolist() == closed(200, links.tolist())


# --- SimHash ---------------------------------------------------------------
def slow_print(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, budget):
    links = [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= budget]
    return closed(len(prints), links)


def test_fingerprint():
    for text in ("", None, "One", "One two THREE", "a b c d e f ÀÉ İ x\x0by", "w " * 70_000, "x y z q r s"):
        assert simhash.fingerprint(text) == slow_print(text)


@pytest.mark.parametrize("budget", [0, 2, 4])
def test_trie_forest(spark, budget):
    rng = np.random.default_rng(budget)
    near = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    for _ in range(240):
        x = near[rng.integers(0, len(near))]
        for b in rng.integers(0, 64, rng.integers(1, 6)):
            x ^= 1 << int(b)
        near.append(x)
    prints = sorted(set(near))
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in prints]
    want = slow_groups(prints, budget)
    for group_rows in (20_000, 7):
        edges = simhash.trie_forest(spark.createDataFrame([(x,) for x in signed], "bits long"), budget, group_rows)
        at = {x: i for i, x in enumerate(signed)}
        assert closed(len(prints), [(at[r.a], at[r.b]) for r in edges.collect()]) == want


def test_near_groups(documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    prints = [slow_print(t) for _, t in rows]
    want = slow_groups(prints, 4)
    got = {r.doc_id: r for r in simhash.near_groups(documents).collect()}
    for (i, _), p, c in zip(rows, prints, want):
        assert (got[i].fingerprint, got[i].component_id) == (f"{p:016x}", rows[c][0])


def test_near_groups_of_odd_rows(odd, empty):
    got = simhash.near_groups(odd).collect()
    assert len(got) == len(ODD)
    blank = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.component_id for r in blank} == {3} and len(blank) == 4
    left = simhash.drop_near_copies(odd)
    assert left.columns == odd.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids[3] == 1 and ids[4] == 0 and ids[2] == 0 and ids[1] == 1 and ids[None] == 2
    assert simhash.near_groups(empty).count() == 0


def test_near_copies_go_by_row(spark):
    line = " ".join(f"word{i}" for i in range(3000))
    near, other = line + " end", "something else altogether that links to nothing here"
    rows = ([(1, line), (1, near), (1, line), (2, near), (1, other)] + [(None, near)] * 3 + [(None, line)]
            + [(7, "one more text without any copy"), (None, "only rows without an id"),
               (None, "only rows without an id")])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert bin(simhash.fingerprint(line) ^ simhash.fingerprint(near)).count("1") <= 4
    left = Counter((r.doc_id, r.text) for r in simhash.drop_near_copies(docs).collect())
    assert set(left.values()) == {1}
    assert Counter((i, t[:4]) for i, t in left) == Counter(
        [(1, "word"), (None, "word"), (1, "some"), (7, "one "), (None, "only")])


# --- embeddings ------------------------------------------------------------
def vectors(rng, n=300, d=16):
    base = rng.normal(size=(40, d))
    x = base[rng.integers(0, 40, n)] + rng.normal(size=(n, d)) * rng.uniform(0.02, 0.3, (n, 1))
    x[5] = x[9] = x[200]
    x[17] = 3 * x[18]
    return x


@pytest.mark.parametrize("cell_rows", [4096, 25])
def test_near_vectors(spark, cell_rows):
    x = vectors(np.random.default_rng(3))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    want = closed(len(x), np.argwhere(near).tolist())
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0),
           (904, [1.0, None] * 8, 0), (905, [float("inf")] * 16, 0), (906, [1.0, 0.0], 0), (907, [1.0, 0.1], 0),
           (908, [-0.0, 1.0], 0), (909, [0.0, 1.0], 0), (None, [5.0], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, vec int")
    got = {r.vec_id: r for r in embeddings.near_vectors(df, 0.9, cell_rows).collect()}
    assert len(got) == len(rows) + len(odd)
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum() - 1, want[i], want[i] == i)
    for i in range(900, 906):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert [(got[i].n_links, got[i].component_id) for i in (906, 907, 908, 909)] == [
        (1, 906), (1, 906), (1, 908), (1, 908)]
    assert not got[None].kept


def test_near_vectors_takes_disk_in_proportion_to_the_input(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(2000, 64))                     # no structure: every vector visits nearly every cell
    x[1000:1400] = x[:400] + 0.02 * rng.normal(size=(400, 64))
    x[1400:1440] = x[7] + 0.03 * rng.normal(size=(40, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    want = closed(len(x), np.argwhere(near).tolist())
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def on_disk():
        return sum(os.stat(f"{d}/{f}").st_size for top in folders for d, _, names in os.walk(top) for f in names
                   if f.startswith("shuffle"))

    before = on_disk()
    got = {r.vec_id: r for r in embeddings.near_vectors(df, 0.9, 50).collect()}
    grown = on_disk() - before
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum() - 1, want[i], want[i] == i)
    assert grown < 6 * x.nbytes                         # a copy per cell visited takes some 35 times as much


def _block(x, axes, weight=None):
    ids, n = np.arange(len(x)), np.ones(len(x), np.int64) if weight is None else weight
    return embeddings.Block.open(ids.tobytes(), n.tobytes(), x.tobytes(), "<f8", axes)


@pytest.mark.parametrize("noise", [0.02, 0.3])
def test_bounds_on_leading_axes_lose_no_link(noise):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 96))[rng.integers(0, 60, 900)] + noise * rng.normal(size=(900, 96))
    x[700:] = x[0] + 0.2 * rng.normal(size=(200, 96))   # a dense tile
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    axes = embeddings.fit_axes(unit[::2], 0.9)
    assert noise > 0.1 or axes.lead < 72
    axes = axes or embeddings.Axes(np.linalg.qr(rng.normal(size=(96, 96)))[0], 24)     # too many pairs near the threshold
    one, two = (_block(x[a:b], axes, rng.integers(1, 4, b - a)) for a, b in ((0, 500), (500, 900)))
    near = unit[:500] @ unit[500:].T >= 0.9
    ids, _, sums = embeddings.block_links(one, two, 0.9)
    want = np.concatenate([near @ two.weight, one.weight @ near])
    assert sums.tolist() == want[want > 0].tolist()
    assert ids.tolist() == np.concatenate([np.arange(500), np.arange(400)])[want > 0].tolist()


def test_near_vectors_of_nothing(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    bad = spark.createDataFrame([(1, None), (None, [0.0])], "vec_id long, embedding array<double>")
    assert sorted((str(r.vec_id), r.n_links, r.kept) for r in embeddings.near_vectors(bad).collect()) == [
        ("1", 0, True), ("None", 0, False)]


# --- language --------------------------------------------------------------
def test_language_of_held_out(documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    got = langid.identify(documents).collect()
    assert len(got) == len(lang)
    for r in got:
        assert r.held_out == (fold(r.doc_id) == 0) and 0 <= r.score <= 1
    test = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) >= 0.95 * len(test)


def test_labels_of_held_out_rows_are_not_used(spark, documents):
    changed = documents.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang")))
    a = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify(documents).collect()}
    assert a == {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify(changed).collect()}


def test_mixture_proportions():
    rng = np.random.default_rng(0)
    like = np.full((3, 100), 1e-6)
    like[0, :60], like[1, 60:95] = 1.0, 1.0
    like[2, 95:] = like[0, 95:] = 0.5
    like += rng.random(like.shape) * 1e-7
    share = langid.select_languages(like, np.array([100]))[:, 0]
    assert share == pytest.approx([0.65, 0.35, 0.0], abs=0.02)


def slow_languages(like, rounds=8):
    """Best nested set of one document (words x languages), every size tried in plain float64."""
    n, k = like.shape

    def em(share, times):
        for _ in range(times):
            part = share * like
            share = (part / part.sum(axis=1, keepdims=True)).sum(axis=0) / n
        return share, np.log((share * like).sum(axis=1)).sum()

    full, _ = em(np.full(k, 1 / k), rounds)
    rank = np.argsort(np.argsort(-full, kind="stable"), kind="stable")
    best, chosen = -np.inf, None
    for size in range(1, k + 1):
        start = np.where(rank < size, np.maximum(full, 1e-3), 0)
        share, value = em(start / start.sum(), rounds * (size > 1))
        value -= 0.5 * (size - 1) * np.log(max(n, 2))
        if value > best + 1e-6:
            best, chosen = value, share
    return chosen


def test_eight_languages_in_one_text():
    like = np.full((8, 160), 1e-6)
    for k in range(8):
        like[k, 20 * k:20 * k + 20] = 1.0
    assert langid.select_languages(like, np.array([160]))[:, 0] == pytest.approx([0.125] * 8, abs=0.01)


def test_language_sets_equal_brute_force():
    rng = np.random.default_rng(4)
    docs = []
    for _ in range(120):
        n, k = int(rng.integers(1, 60)), 6
        like = rng.random((n, k)) ** rng.integers(1, 12)
        docs.append(like / like.max(axis=1, keepdims=True) + 1e-12)
    got = langid.select_languages(np.concatenate(docs).T.copy(), np.array([len(d) for d in docs]))
    sizes = set()
    for i, like in enumerate(docs):
        want = slow_languages(like)
        assert got[:, i] == pytest.approx(want, abs=1e-6), i
        sizes.add(int((want > 0).sum()))
    assert len(sizes) > 2


def test_a_column_that_is_no_language_is_refused(spark):
    many = spark.range(400).selectExpr("id doc_id", "'a b' text", "string(id) lang")
    with pytest.raises(ValueError):
        langid.fit(many)


def test_wanted_languages_and_share(spark, documents):
    guess = {r.doc_id: r for r in langid.identify(documents).collect()}
    kept = {r.doc_id for r in langid.keep_identified(documents, wanted=["de", "fr"], least=0.9).collect()}
    assert kept == {k for k, r in guess.items() if r.lang_pred in ("de", "fr") and r.score >= 0.9} and kept


def test_language_of_odd_rows(odd, empty):
    got = langid.identify(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(d[0] for d in ODD)
    for r in got:
        if r.doc_id in (3, 4, 5, 7):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "fr")
    left = langid.keep_identified(odd)
    assert left.columns == odd.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 2, 2, None, 8, 9])
    unknown = odd.withColumn("lang", F.lit(None).cast("string"))
    assert langid.identify(unknown).where("lang_pred <> 'und'").count() == 0
    assert langid.keep_identified(unknown).count() == 6
    assert langid.identify(empty).count() == 0


# --- toxicity --------------------------------------------------------------
def test_label_model_sees_through_copied_voters():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    good = [np.where(rng.random(4000) < 0.9, y, ~y) for _ in range(3)]
    copied = np.where(rng.random(4000) < 0.6, y, ~y)
    votes = np.column_stack([*good, *[copied] * 5]).astype(float)
    gold = np.where(rng.random(4000) < 0.85, y, ~y)
    q, model = toxicity.label_model(votes, gold)
    assert ((q > 0.5) == y).mean() > 0.93
    assert model["weight"][3:].sum() < 1.5 and model["weight"][:3].min() > 0.8
    assert model["fires_if_toxic"][0] == pytest.approx(0.9, abs=0.05)


def test_toxic_words_are_learned(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefg"), 5)) for _ in range(400)]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        line = list(rng.choice(words, 30)) + ([f"zzgrob{rng.integers(99)}"] if toxic else [])
        docs.append((i, " ".join(line)))
        labels.append((i, 0, int(toxic)))
    docs += [(1000, "You are an idiot, you pathetic loser!!!"), (1001, None), (1002, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.rate_toxicity(d, lab).collect()}
    assert len(got) == len(docs)
    test = [r for r in got.values() if r.held_out and r.doc_id < 900]
    assert all(r.predicted == (r.doc_id % 6 == 0) for r in test) and len(test) > 100
    assert all(r.predicted == (r.score >= 0.5) for r in got.values())
    assert got[1001].score == got[1002].score < 0.5


def test_toxicity_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.rate_toxicity(odd, none).collect()} == {0}
    assert toxicity.rate_toxicity(odd, none).count() == len(ODD)
    assert toxicity.rate_toxicity(empty, none).count() == 0


# --- personal data ---------------------------------------------------------
def slow_base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10))
                                      for i, x in enumerate(reversed(d))) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_spans():
    rng = np.random.default_rng(8)
    parts = ["a@b.c", "x.y@d-e.f.g", "@", "..", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (234) 555-2368",
             "é", " ", "-", "+", "12", "4111111111111111", "00.0.0.0", "a@b", "@c.d", "_d@e.f", "1.2.3.4.5", "٣"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 9)))
        assert pii.base_spans(text) == slow_base(text), text
    assert pii.base_spans("a" * 200_000) == [] and pii.base_spans("1" * 100_000 + ".") == []


def test_gradients_of_the_tagger():
    texts, tags = ["a1@b.c x", "12.3"], [[1, 2, 2, 2, 2, 2, 0, 0], [3, 4, 4, 4]]
    model = pii.new_model(1)
    code, real = pii.encode(texts)

    def loss(m):
        score, _ = pii.emissions(m, code, real)
        _, _, whole = pii.marginals(score, real, m["move"])
        total = 0.0
        for j, t in enumerate(tags):
            total += whole[j] - pii.FIRST[t[0]] - sum(score[i, j, k] for i, k in enumerate(t))
            total -= sum(m["move"][a, b] + pii.ALLOWED[a, b] for a, b in zip(t, t[1:]))
        return total

    score, (x, both, tf, tb) = pii.emissions(model, code, real, True)
    prob, _, _ = pii.marginals(score, real, model["move"])
    d = prob * real[:, :, None]
    for j, t in enumerate(tags):
        for i, k in enumerate(t):
            d[i, j, k] -= 1
    dboth = d @ model["out"].T
    dw, _, _ = pii.lstm_back(dboth[:, :, :pii.HIDDEN], x, model["f"], tf)
    for a, b in ((0, 0), (3, 25), (pii.EMBED + 2, 40), (pii.EMBED + 5, 70)):
        up, down = ({**model, "f": model["f"].copy()} for _ in range(2))
        up["f"][a, b] += 1e-5
        down["f"][a, b] -= 1e-5
        assert dw[a, b] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-6)


def test_reconcile():
    base = [(10, 0, 20)]
    found = [(0, 2, 8, 0.95), (0, 2, 9, 0.97), (15, 1, 25, 0.99), (30, 3, 40, 0.99), (35, 2, 45, 0.91),
             (41, 2, 50, 0.95), (60, 1, 70, 0.5), (30, 3, 40, 0.92)]
    assert pii.reconcile(found, base, 0.9) == [(0, 2, 9), (10, 0, 20), (30, 3, 40), (41, 2, 50)]


def test_reconcile_tests_each_candidate_on_its_own():
    base = [(20, 0, 30)]
    assert pii.reconcile([(0, 2, 50, 0.99), (10, 1, 15, 0.95)], base, 0.9) == [(10, 1, 15), (20, 0, 30)]
    rng = np.random.default_rng(3)
    for _ in range(200):
        base = [(int(a), 0, int(a + n)) for a, n in zip(rng.integers(0, 200, 4), rng.integers(1, 30, 4))]
        found = [(int(a), 1, int(a + n), 0.95) for a, n in zip(rng.integers(0, 200, 9), rng.integers(1, 60, 9))]
        clear = [f for f in found if not any(x < f[2] and f[0] < y for x, _, y in base)]
        assert pii.reconcile(found, base, 0.9) == sorted([*base, *pii.reconcile(clear, [], 0.9)])


def test_windows_cover_anchors():
    text = "x" * 500 + "1" + "y" * 1000 + "@" + "z" * 10
    runs = pii.stretches(text)
    for p in (500, 1501):
        assert any(a <= max(0, p - 32) and p < b for s, e in runs for a, b in pii.windows(s, e - s)), runs
    assert pii.stretches("no anchor") == []


def test_find_personal(documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    got = pii.find_personal(documents).collect()
    assert len(got) == len(rows)
    for r in got:
        base = slow_base(rows[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",")] if r.spans else []
        assert {tuple(s) for s in spans} >= {(pii.KINDS[k], str(a), str(b)) for a, k, b in base}
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert r.n_added == len(spans) - len(base)


def test_personal_data_of_odd_rows(odd, empty):
    got = pii.find_personal(odd).collect()
    assert len(got) == len(ODD)
    row = next(r for r in got if r.doc_id == 9)
    assert row.n_email == 1 and row.n_card >= 1
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.doc_id in (3, 4, 5))
    assert pii.find_personal(empty).count() == 0


# --- pieces ----------------------------------------------------------------
@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(pieces.serialised(pieces.MODEL))


def test_sampling_follows_the_lattice(model):
    """Frequencies of sampled segmentations against all segmentations, enumerated."""
    unit = " there"

    def ways(i):
        if i == len(unit):
            yield (), 0.0
        for j in range(i + 1, len(unit) + 1):
            k = model.ids.get(unit[i:j])
            if k is not None:
                for rest, p in ways(j):
                    yield (k, *rest), model.logp[k] + p
    every = dict(ways(0))
    whole = sum(math.exp(p) for p in every.values())
    n = 20_000
    ids, counts = pieces.sample_texts(model, ["there"] * n, list(range(n)))
    seen = Counter(tuple(x) for x in np.split(ids, np.cumsum(counts)[:-1]))
    assert set(map(tuple, seen)) <= set(every)
    for way, p in every.items():
        p = math.exp(p) / whole
        assert abs(seen.get(way, 0) / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_pieces_round_trip(spark, odd, empty, model):
    texts = [None, "", " ", "  two  blanks ", "tab\tand\nline\r\n", "▁ literal ▁▁", "日本語 😀 é", "\x00\x01",
             "a" * 5000, "word " * 4000, "  x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pieces.encode(df)
    back = {r.doc_id: r.text for r in pieces.decode(got).collect()}
    assert back == dict(enumerate(texts))
    for r in got.collect():
        assert r.lossless and r.n_pieces == len(r.ids or []) and (r.ids is None) == (texts[r.doc_id] is None)
        assert r.n_bytes == len((texts[r.doc_id] or "").encode())
    assert pieces.encode(odd).where("lossless").count() == len(ODD)
    assert pieces.encode(empty).count() == 0


def test_pieces_do_not_depend_on_partitions(documents):
    one = {r.doc_id: r.ids for r in pieces.encode(documents.repartition(1)).collect()}
    many = {r.doc_id: r.ids for r in pieces.encode(documents.repartition(9)).collect()}
    assert one == many
    other = {r.doc_id: r.ids for r in pieces.encode(documents, seed=1).collect()}
    assert sum(one[k] != other[k] for k in one) > len(one) // 2


# --- token output ----------------------------------------------------------
@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000])
def test_feistel_is_a_permutation(size):
    a, b = (tokens.feistel(np.arange(size), size, k) for k in ("k1", "k2"))
    assert sorted(a.tolist()) == list(range(size))
    assert size < 64 or a.tolist() != b.tolist()


def test_training_order(spark, documents, tmp_path):
    length, shard_slots = 128, 300
    got = tokens.training_order(documents, "key", length, shard_slots)
    rows = sorted(got.collect(), key=lambda r: r.slot)
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n)) and sorted(r["index"] for r in rows) == list(range(n))
    assert tokens.feistel(np.array([r["index"] for r in rows]), n, "key").tolist() == list(range(n))
    # in index order the sequences are the documents' tokens, one after another
    with open(tokens.VOCABULARY, "rb") as f:
        tok = tokens.Tokens(f.read())
    stream = np.concatenate([np.frombuffer(r.record, "<u2")[:r.n_tokens] for r in sorted(rows, key=lambda r: r["index"])])
    docs = [r.text for r in documents.collect()]
    assert tok.encoding.decode(tok.encode(docs[0])[:-1].tolist()) == docs[0]
    ends = np.flatnonzero(stream == tokens.END)
    cut = [tok.encoding.decode(stream[a:b].tolist()) for a, b in zip(np.append(0, ends[:-1] + 1), ends)]
    assert Counter(cut) == Counter(docs)
    assert set().union(*(r.doc_ids for r in rows)) == {r.doc_id for r in documents.collect()}
    # fixed stride on disk, and a reader that starts anywhere
    path = str(tmp_path / "shards")
    tokens.write_shards(got, path)
    files = sorted((tmp_path / "shards").glob("shard=*/part-*"))
    assert len(files) == -(-n // shard_slots)
    stride = 2 * length + 1
    raw = files[0].read_bytes()
    assert len(raw) == shard_slots * stride
    for r in (rows[0], rows[17]):
        assert raw[r.slot * stride:r.slot * stride + 2 * length] == bytes(r.record) and r.offset == r.slot * stride
    lo, hi = shard_slots - 5, shard_slots + 5
    read = tokens.read_slots(spark, path, lo, hi, length, shard_slots).collect()
    assert [(r.slot, bytes(r.record)) for r in read] == [(r.slot, bytes(r.record)) for r in rows[lo:hi]]


def test_token_output_of_odd_rows(odd, empty):
    got = tokens.training_order(odd, length=16).collect()
    ends = sum((np.frombuffer(r.record, "<u2")[:r.n_tokens] == tokens.END).sum() for r in got)
    assert ends == len(ODD)
    assert tokens.training_order(empty).count() == 0


def test_token_output_writes_shards_and_reads_its_rows_from_them(spark, documents, empty, tmp_path):
    length, shard_slots = 128, 300
    want = sorted(tokens.training_order(documents, "key", length, shard_slots).collect(), key=lambda r: r.slot)
    path = tmp_path / "shards"
    got = tokens.token_output(documents, "key", length, shard_slots, path=str(path))
    assert sorted(got.collect(), key=lambda r: r.slot) == want and got.schema == tokens.training_order(empty).schema
    files = sorted(path.glob("shard=*/part-*"), key=lambda f: int(f.parent.name[6:]))
    assert len(files) == -(-len(want) // shard_slots) > tokens.SHARES
    assert b"".join(f.read_bytes() for f in files) == b"".join(bytes(r.record) + b"\n" for r in want)
    # the returned records are those of the files
    raw = bytearray(files[0].read_bytes())
    raw[want[3].offset] ^= 1
    files[0].write_bytes(raw)
    (files[0].parent / f".{files[0].name}.crc").unlink()
    changed = {r.slot for r, w in zip(sorted(got.select("*").collect(), key=lambda r: r.slot), want) if r != w}
    assert changed == {3}
    assert tokens.token_output(empty).count() == 0


def test_registered_token_output_writes_shards(spark):
    from equitas.llm.handover import folder
    from equitas.llm.queries import QUERIES
    shards = os.path.join(folder(spark).removeprefix("file:"), "shards-*", "shard=*", "part-*")
    before = set(glob.glob(shards))
    got = QUERIES["op9_token_output"](spark, SF).collect()
    new = set(glob.glob(shards)) - before
    assert sum(os.path.getsize(f) for f in new) == len(got) * (2 * tokens.LENGTH + 1) > 0


# --- pipeline --------------------------------------------------------------
def test_pipeline(spark, documents):
    """Each stage against brute force on what its predecessor kept."""
    docs = documents
    columns = sorted(docs.columns)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mix", "pieces"]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.handover(stage(spark, docs, ""), name)
        was, now = docs.collect(), out.collect()
        if name == "language_id":
            langs, table = langid.fit(docs, where=~langid.held_out())
            want = []
            for r in was:
                words = langid.words_of(r.text)
                if any(c.isalpha() for w in words for c in w):
                    value = np.array([table[langid.trigrams([w])[0]].sum(axis=0, dtype=float) for w in words])
                    like = np.exp(np.maximum(value - value.max(axis=1, keepdims=True), -60))
                    if slow_languages(like).max() >= 0.5:
                        want.append(r.doc_id)
        elif name == "exact_dedup":
            first = {}
            for r in sorted(was, key=lambda r: r.doc_id):
                first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r.text or ""), r.doc_id)
            want = list(first.values())
        elif name == "near_dedup":
            ordered = sorted(was, key=lambda r: r.doc_id)
            want = [r.doc_id for i, (r, c) in enumerate(zip(
                ordered, slow_groups([slow_print(r.text) for r in ordered], 4))) if c == i]
        else:
            want = None
        if want is not None:
            assert sorted(r.doc_id for r in now) == sorted(want)
        if name == "mix":
            copies = {r.doc_id: r.copies for r in corpus_pipeline.mixed_documents.__globals__["mix_sources"](docs).collect()}
            assert Counter(r.doc_id for r in now) == Counter({k: v for k, v in copies.items() if v})
        if name == "pieces":
            text = {r.doc_id: r.text for r in was}
            assert {r.doc_id: r.text for r in pieces.decode(out).collect()} == text and len(now) == len(was)
        else:
            assert sorted(out.columns) == columns
        docs = out


def test_pipeline_of_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.handover(stage(spark, docs, ""), name)
        assert docs.columns == ["doc_id", "ids", "n_pieces", "n_bytes", "lossless"]
