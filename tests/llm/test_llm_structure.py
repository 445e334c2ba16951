"""Operators 11 to 13: against brute force, hand cases, and held-out accuracy."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from equitas.llm import conversations as talk
from equitas.llm import periodic, quality

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string, `Copies` string, place long, PIECE string"


# ---------------------------------------------------------------- operator 11
def sound(initials):
    s = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(s) >= 2 and len(s) % 2 == 0 and s == "ua" * (len(s) // 2))


def brute_repair(rows):
    """(cost, audit, messages) by trying every edit of every row and up to two inserts at every place.

    Two are enough: an optimal repair never needs more to reach any state.
    """
    best = None
    seen, kinds = set(), []
    for role, text in rows:
        tail = text.strip(" \t\n\x0b\x0c\r")
        must = not tail or (role, text) in seen
        kinds.append((must, bool(tail) and tail[-1] not in ".!?"))
        seen.add((role, text))
    for ops in itertools.product(*[("D",) if must else ("K", "Ru", "Ra", "D") for must, _ in kinds]):
        for ins in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for i in range(len(rows) + 1):
                for r in ins[i]:
                    cost, audit = cost + 3, audit + "I"
                    out.append((talk.ROLE_OF[r], ""))
                if i == len(rows):
                    break
                op, (role, text) = ops[i], rows[i]
                audit += op[0]
                cost += {"K": 0, "R": 3, "D": 4}[op[0]] + (3 if op != "D" and kinds[i][1] else 0)
                if op != "D":
                    out.append((role if op == "K" else talk.ROLE_OF[op[1]], text))
            if sound("".join(r[:1] or "?" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return best


def sha(messages):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest()


def test_repairs_equal_exhaustive_search(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for conv in range(60):
        mine = []
        for turn in range(rng.randint(0, 3)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            mine.append((role, rng.choice(["", " \n", "a.", "b!", f"c{turn}", f"d{turn}.", f"e{turn}? \n"])))
        rows += [(conv, turn, r, t) for turn, (r, t) in enumerate(mine)]
        if mine:
            want[conv] = brute_repair(mine)
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in talk.repair_conversations(convs).collect()}
    assert set(got) == set(want)
    for conv, (cost, audit, messages) in want.items():
        assert (got[conv]["cost"], got[conv]["audit"]) == (cost, audit), conv
        assert got[conv]["repaired_sha256"] == sha(messages), conv


def test_pieces_and_merge_rounds_change_nothing(spark, monkeypatch):
    """A conversation over many pieces, merged two at a time, equals the one parsed whole."""
    rng = random.Random(3)
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "system"]),
             rng.choice(["yes.", "no", "", f"m{rng.randrange(30)}.", f"m{t}!"]))
            for c, n in ((1, 150), (2, 40), (3, 1), (None, 25)) for t in range(n)]
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    whole = sorted(map(str, talk.repair_conversations(convs).collect()))
    monkeypatch.setattr(talk, "PIECE_BITS", 2)
    monkeypatch.setattr(talk, "FAN_BITS", 1)
    monkeypatch.setattr(talk, "FAN", 2)
    assert sorted(map(str, talk.repair_conversations(convs).collect())) == whole


def test_conversation_edge_cases(spark):
    long = "word " * 200_000 + "."
    rows = [(1, 0, "user", "Hi.", "x", 1, "y"), (1, 0, "user", "Hi.", "x", 1, "y"), (1, 1, "assistant", "Yo.", "x", 1, "y"),
            (2, None, None, None, None, None, None), (2, 5, "user", long, None, None, None),
            (None, 3, "assistant", "Alone", None, None, None), (None, 9, "user", "Late.", None, None, None)]
    convs = spark.createDataFrame(rows, CONV)
    got = {r["conv_id"]: r for r in talk.repair_conversations(talk.only(convs, "conv_id", "turn", "role", "text")).collect()}
    assert (got[1]["audit"], got[1]["cost"], got[1]["duplicate"], got[1]["illegal"], got[1]["gaps"]) == ("KDK", 4, 1, 1, 0)
    assert got[1]["repaired_sha256"] == sha([("user", "Hi."), ("assistant", "Yo.")])
    assert (got[2]["audit"], got[2]["cost"], got[2]["blank"], got[2]["gaps"]) == ("DKI", 7, 1, 0)
    assert got[2]["repaired_sha256"] == sha([("user", long), ("assistant", "")])
    # alone: delete (4) and then insert after the user's (3) = 7; or I K(trunc 3) K I = 9
    assert (got[None]["audit"], got[None]["cost"], got[None]["gaps"], got[None]["truncated"]) == ("DKI", 7, 5, 1)
    nothing = spark.createDataFrame([], CONV)
    assert talk.repair_conversations(talk.damage(nothing)).count() == 0


def test_damage_keeps_every_conversation(spark):
    convs = spark.createDataFrame([(c, t, "user", f"{c} {t}. ok!") for c in range(60) for t in range(2)],
                                  "conv_id long, turn long, role string, text string")
    hurt = {(r["conv_id"], r["turn"]): r for r in talk.damage(convs).collect()}
    for (c, t), r in hurt.items():
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        assert r["copies"] == {0: 0, 3: 2}.get(kind, 1)
        assert r["text"] == {1: "", 2: f"{c} {t} ok"}.get(kind, f"{c} {t}. ok!")
    gone = [c for c in range(60) if all(hurt[c, t]["copies"] == 0 for t in range(2))]
    got = {r["conv_id"]: r for r in talk.repair_conversations(talk.damage(convs)).collect()}
    assert set(got) == set(range(60))
    alone = spark.createDataFrame([(c, t, "user", "x.") for c, t in hurt if hurt[c, t]["copies"] == 0 and t == 0],
                                  "conv_id long, turn long, role string, text string")
    for r in talk.repair_conversations(talk.damage(alone)).collect():
        assert (r["audit"], r["cost"], r["gaps"], r["repaired_sha256"]) == ("", 0, 0, hashlib.sha256().hexdigest())
    assert all(got[c]["audit"] == "" for c in gone)


def test_repaired_messages_are_sound(spark):
    convs = spark.read.parquet(f"{SF}/conversations.parquet")
    hurt = talk.damage(convs)
    repairs = talk.find_repairs(hurt)
    said = {}
    for r in sorted(talk.repaired_messages(hurt, repairs).collect(), key=lambda r: (r["conv_id"], r["place"])):
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for r in talk.repair_conversations(hurt).collect():
        mine = said.get(r["conv_id"], [])
        assert sound("".join(role[:1] for role, _ in mine))
        assert r["repaired_sha256"] == sha(mine)


# ---------------------------------------------------------------- operator 12
def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(5)
    per_text = np.array([3, 1, 5, 2])
    emit, edge, begin = rng.normal(size=11), rng.normal(size=(2, 2)), rng.normal(size=2)
    good, log_z, pairs = quality.forward_backward(emit, per_text, edge, begin)
    at, count = 0, np.zeros((2, 2))
    for k, n in enumerate(per_text):
        total, up = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(begin[y[0]] + sum(emit[at + i] * y[i] for i in range(n))
                       + sum(edge[y[i], y[i + 1]] for i in range(n - 1)))
            total += w
            up += w * np.array(y)
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(begin[y[0]] + sum(emit[at + i] * y[i] for i in range(n))
                       + sum(edge[y[i], y[i + 1]] for i in range(n - 1)))
            for i in range(n - 1):
                count[y[i], y[i + 1]] += w / total
        assert np.allclose(good[at:at + n], up / total)
        assert np.isclose(log_z[k], np.log(total))
        at += n
    assert np.allclose(pairs, count)


def test_gradient_equals_differences():
    texts = ["One line.\nTwo lines here.\n", "!!! ###", "A B C\n\nA B C\nlast"]
    figures, per_text, _ = quality.line_figures(texts)
    field = quality.Field(quality.bin_edges(figures))
    rng = np.random.default_rng(1)
    field.flat = rng.normal(size=len(field.flat)) / 5
    at = quality.places(figures, per_text, field.edges)
    labels = rng.integers(0, 2, len(figures))
    _, grad = quality.likelihood(field, at, per_text, labels, 0.01)
    for i in [*rng.choice(np.unique(at), 25), *range(len(field.flat) - 7, len(field.flat))]:
        ends = []
        for step in (1e-5, -1e-5):
            moved = quality.Field(field.edges, field.flat.copy())
            moved.flat[i] += step
            ends.append(quality.likelihood(moved, at, per_text, labels, 0.01)[0])
        assert np.isclose(grad[i], (ends[0] - ends[1]) / 2e-5, atol=1e-6)


def test_neighbours_stay_within_a_text():
    alone = quality.places(*quality.line_figures(["x y."])[:2], np.zeros((len(quality.FIGURES), 3)))
    several = quality.places(*quality.line_figures(["AB!!\ncd", "x y.", "", "### 1"])[:2],
                             np.zeros((len(quality.FIGURES), 3)))
    assert (several[2] == alone[0]).all()


def test_quality_held_out(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.rate_quality(documents, labels).join(labels, "doc_id").toPandas()
    test = got[got["held_out"]]
    up, down = test[test["quality"] == 1]["score"], test[test["quality"] == 0]["score"]
    if len(up) and len(down):
        assert np.mean([u > d for u in up for d in down]) > 0.9
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    assert got[got["quality"] == 1]["predicted"].mean() > 0.95


def test_quality_edge_cases(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, "x"), (7, 0, "x"), (8, 1, "x"), (9, 0, "x"), (None, 1, "x"), (2, None, "x")],
                                   "doc_id long, quality int, text string")
    got = quality.rate_quality(odd, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.rate_quality(empty, labels).count() == 0
    assert {r["score"] for r in quality.rate_quality(odd, labels.where("quality = 1")).collect()} == {1.0}
    assert {r["score"] for r in quality.rate_quality(odd, labels.limit(0)).collect()} == {1.0}


# ---------------------------------------------------------------- operator 13
def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(24, 3 * q) and not any(
                    all(words[k] == words[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(7)
    found = 0
    for _ in range(1500):
        n, k = rng.randint(0, 140), rng.choice([1, 2, 3, 8, 40])
        words = [str(rng.randrange(k)) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 5:
                a, stop = rng.randrange(n), rng.randint(0, n)
                p = rng.randint(1, max(1, (n - a) // 2))
                words[a:stop] = [words[a + i % p] for i in range(stop - a)]
        assert periodic.find_runs(words) == brute_runs(words)
        found += len(brute_runs(words))
    assert found > 200


def test_splitting_recurses_to_stability():
    rng = random.Random(2)
    for _ in range(300):
        words = [str(int(rng.expovariate(0.4))) for _ in range(rng.randint(0, 200))]
        parts = [(0, len(words))]
        while True:                                                # plain recursion by rounds
            new = []
            for a, b in parts:
                edge = [a - 1, *(i for i in range(a, b) if words[a:b].count(words[i]) < 3), b]
                new += [(x + 1, y) for x, y in zip(edge, edge[1:]) if y - x > 1]
            if new == parts:
                break
            parts = new
        assert periodic.surviving_segments(words, least=1) == sorted(parts)


def test_periodic_query_columns(spark, documents, odd, empty):
    for docs, plant in ((documents, True), (odd, False), (odd, True)):
        want = []
        for r in docs.select("doc_id", "text").collect():
            words = (r["text"] or "").encode().split()
            if plant:
                h = zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode())
                n, g = len(words), h // 10
                if h % 10 == 0 and n:
                    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
                    words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            runs = periodic.find_runs(words)
            if len(words) < 2000:
                assert runs == brute_runs(words)
            best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None, None, None)
            gone = {i for a, n, q in runs for i in range(a + q, a + n)}
            want.append((r["doc_id"], len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                         hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest(),
                         hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()))
        got = [tuple(r)[:8] for r in periodic.periodic_runs(docs, plant=plant).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert periodic.periodic_runs(empty).count() == 0


def test_hostile_texts_stay_fast():
    fib, more = "0", "01"
    while len(more) < 30_000:
        fib, more = more, more + fib
    periodic.find_runs(list(more))
    assert periodic.find_runs(["a"] * 100_000) == [(0, 100_000, 1)]
    block = [str(i) for i in range(20_000)]
    assert periodic.find_runs(block * 3) == [(0, 60_000, 20_000)]


@pytest.mark.parametrize("text", [None, "", " \n\t"])
def test_no_words_no_run(text):
    assert periodic.describe(text)[:5] == (0, None, None, None, None)
