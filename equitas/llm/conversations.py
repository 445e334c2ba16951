"""Operator 11: conversation structure repair by a lightest-derivation agenda.

A conversation is sound if the first letters of its roles read ``(s?(ua)+)?``.
Items of the deduction system are (row i, state q): the first i rows are edited
and what is left has brought the automaton to q. Edits are weighted deductions
between items, and tables of (entry, exit) weights of consecutive pieces combine
by one more deduction, so a conversation of any length is parsed in pieces of
bounded size that are merged in rounds. A weight is (cost, audit): costs add,
audits are joined. Both functions are superior (no result is lighter than an
argument) and monotone, since the audit and the entry state fix the cost and the
exit state, so equal costs never meet audits of which one begins the other.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .handover import handover, only, width

#: Distinct rows of a piece are at most 2 ** PIECE_BITS; a merge joins at most FAN pieces.
PIECE_BITS, FAN_BITS = 8, 6
FAN = 1 << FAN_BITS
ROLE_OF = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"

#: States: nothing yet, after the system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
         (USER, "a"): ASSISTANT}
GOALS = (EMPTY, ASSISTANT)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

Weight = tuple[int, str]
Step = Callable[[int, int], Iterable[tuple[int, int, int, str]]]


def agenda(start: int, step: Step, last: int, goals: tuple[int, ...] | None = None) -> dict[int, Weight]:
    """Weights of the items (last, q) that follow from the axiom (0, start).

    Items leave the agenda in order of (cost, audit), and the first weight an
    item leaves with is final. With ``goals`` it stops at the first of them.
    """
    done: set[tuple[int, int]] = set()
    found: dict[int, Weight] = {}
    heap = [(0, "", 0, start)]
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == last:
            found[q] = (cost, audit)
            if goals and q in goals:
                return {q: (cost, audit)}
        for to, state, more, letters in step(i, q):
            if (to, state) not in done:
                heapq.heappush(heap, (cost + more, audit + letters, to, state))
    return found


def row_steps(rows: list[dict]) -> Step:
    """Deductions over rows: initial, fault (blank and repeated rows must go), truncated, copies of one row."""
    def step(i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
        for role in "ua":
            if (q, role) in MOVES:
                yield i, MOVES[q, role], INSERT, "I"
        if i == len(rows):
            return
        row = rows[i]
        n = row["copies"]
        yield i + 1, q, DELETE * n, "D" * n
        if row["blank"] or row["repeated"]:
            return
        kept = TRUNCATED * row["truncated"] + DELETE * (n - 1)     # further copies repeat the first
        rest = "D" * (n - 1)
        if (q, row["initial"]) in MOVES:
            yield i + 1, MOVES[q, row["initial"]], kept, "K" + rest
        for role in "ua":
            if (q, role) in MOVES:
                yield i + 1, MOVES[q, role], REROLE + kept, "R" + rest
    return step


def piece_steps(tables: list[dict[int, list[tuple[int, int, str]]]]) -> Step:
    """Deductions over pieces, from their tables entry -> (exit, cost, audit)."""
    def step(i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
        if i < len(tables):
            for state, cost, audit in tables[i].get(q, ()):
                yield i + 1, state, cost, audit
    return step


COUNTS = ("distinct_turns", "blank", "duplicate", "truncated", "illegal")


def summary(rows: list[dict]) -> dict:
    """Counts of one piece's rows that add up over pieces, with what the seams need."""
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    out = {"min_turn": min(turns, default=None), "max_turn": max(turns, default=None),
           "distinct_turns": len(set(turns)), "first_turn": turns[0] if turns else None,
           "last_turn": turns[-1] if turns else None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
           "first_initial": rows[0]["initial"] if rows else None,
           "last_initial": rows[-1]["initial"] if rows else None}
    before = None
    for r in rows:
        n = r["copies"]
        if r["blank"]:
            out["blank"] += n
        else:
            seen = n if r["repeated"] else n - 1
            out["duplicate"] += seen
            out["truncated"] += (n - seen) * r["truncated"]
        out["illegal"] += (n - 1) + (before is not None and before + r["initial"] not in ("su", "ua", "au"))
        before = r["initial"]
    return out


def join_summaries(a: dict, b: dict) -> dict:
    """The summary of two neighbouring pieces of one conversation."""
    if a["last_initial"] is None or b["first_initial"] is None:
        return b if a["last_initial"] is None else a
    out = {c: a[c] + b[c] for c in COUNTS}
    out["illegal"] += a["last_initial"] + b["first_initial"] not in ("su", "ua", "au")
    out["distinct_turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    for name, pick in (("min_turn", min), ("max_turn", max)):
        have = [x for x in (a[name], b[name]) if x is not None]
        out[name] = pick(have) if have else None
    out["first_turn"] = a["first_turn"] if a["first_turn"] is not None else b["first_turn"]
    out["last_turn"] = b["last_turn"] if b["last_turn"] is not None else a["last_turn"]
    return {**out, "first_initial": a["first_initial"], "last_initial": b["last_initial"]}


def damage(convs: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the row (``copies`` 0), 1 empties its text, 2 takes its sentence
    marks, 3 repeats it, 4 makes it the user's.
    """
    blank = F.lit(" ")
    text, role = F.coalesce(F.col("text").cast("string"), blank), F.coalesce(F.col("role").cast("string"), blank)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    return (only(convs, "conv_id", "turn", "role", "text").withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies")))


def _messages(convs: DataFrame) -> DataFrame:
    copies = F.col("copies") if "copies" in convs.columns else F.lit(1)
    return convs.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
                        copies.cast("long").alias("copies")).withColumn("digest", F.unhex(F.sha2("text", 256)))


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _ordered(messages: DataFrame) -> DataFrame:
    """One thin row per distinct message of a turn, with its copies and its ``place`` in conversation order."""
    tail = F.rtrim(F.col("text"), F.lit(BLANKS))
    thin = messages.select(
        "conv_id", "turn", "role", "digest", "copies", (tail == "").alias("blank"),
        (~F.substring(tail, -1, 1).isin(".", "!", "?")).cast("int").alias("truncated"))
    runs = (thin.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated")
            .agg(F.sum("copies").alias("copies")))
    by = [F.col("conv_id").asc_nulls_first(), *_order()]
    placed = (runs.repartitionByRange(width(runs.sparkSession), *by).sortWithinPartitions(*by)
              .withColumn("place", F.monotonically_increasing_id()))
    return handover(placed, "conversation-rows")


def _repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with ``repeated``: an earlier row of the conversation has the same role and text."""
    first = (rows.where("copies > 0").groupBy("conv_id", "role", "digest")
             .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    same = (F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    return (rows.join(first, same, "left")
            .withColumn("repeated", F.coalesce(F.col("place") > F.col("first"), F.lit(False)))
            .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "blank", "truncated",
                    "repeated", "place"))


def _piece_schema(id_type: T.DataType) -> T.StructType:
    out = T.StructType([T.StructField("conv_id", id_type), T.StructField("piece", T.LongType())])
    for name in ("min_turn", "max_turn", "first_turn", "last_turn", *COUNTS):
        out = out.add(name, T.LongType())
    out = out.add("first_initial", T.StringType()).add("last_initial", T.StringType())
    entry = T.StructType([T.StructField("entry", T.IntegerType()), T.StructField("exit", T.IntegerType()),
                          T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    return out.add("derivations", T.ArrayType(entry))


def _table(start: int, step: Step, last: int) -> list[dict]:
    return [{"entry": start, "exit": q, "cost": c, "audit": a} for q, (c, a) in agenda(start, step, last).items()]


def _batches(records: Iterable[dict], schema: T.StructType, most: int = 2048) -> Iterator[pa.RecordBatch]:
    """``records`` as Arrow batches, ``most`` rows at a time."""
    arrow, records = to_arrow_schema(schema), iter(records)
    while part := list(itertools.islice(records, most)):
        yield from pa.Table.from_pylist(part, schema=arrow).to_batches()


def grouped(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """(key, rows) of each stretch of rows with equal keys."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, part in itertools.groupby(rows, lambda r: tuple(r[k] for k in keys)):
        yield key, list(part)


def _mapped(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: T.StructType,
            keys: list[str], then: str) -> DataFrame:
    """``run`` over each task's rows, dealt by ``keys`` to the whole shuffle width and sorted by them, then ``then``."""
    dealt = rows.repartition(width(rows.sparkSession), *keys).sortWithinPartitions(*keys, then)
    return dealt.mapInArrow(lambda batches: _batches(run(batches), schema), schema)


def _pieces(rows: DataFrame) -> DataFrame:
    """One row per (piece, conversation): counts, and the lightest derivations by entry and exit state."""
    schema = _piece_schema(rows.schema["conv_id"].dataType)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (piece,), rows in grouped(batches, "piece"):
            parts: list[tuple[object, list[dict]]] = []
            for row in rows:
                if not parts or parts[-1][0] != row["conv_id"]:
                    parts.append((row["conv_id"], []))
                if row["copies"]:
                    parts[-1][1].append(row)
            for k, (conv, mine) in enumerate(parts):
                entries = (EMPTY,) if k else (EMPTY, SYSTEM, USER, ASSISTANT)   # only the first may go on from before
                found = [d for q in entries for d in _table(q, row_steps(mine), len(mine))]
                yield {"conv_id": conv, "piece": piece, **summary(mine), "derivations": found}

    dealt = rows.withColumn("piece", F.shiftright("place", PIECE_BITS))
    return handover(_mapped(dealt, parse, schema, ["piece"], "place"), "conversation-pieces")


def _by_entry(found: list[dict]) -> dict[int, list[tuple[int, int, str]]]:
    out: dict[int, list[tuple[int, int, str]]] = {}
    for d in found:
        out.setdefault(d["entry"], []).append((d["exit"], d["cost"], d["audit"]))
    return out


def _total(pieces: list[dict]) -> dict:
    total = pieces[0]
    for p in pieces[1:]:
        total = join_summaries(total, p)
    return total


def _merged(pieces: DataFrame) -> DataFrame:
    """Pieces joined, at most FAN of a conversation at a time, until none has more than FAN of them."""
    schema = pieces.schema

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (conv, _), mine in grouped(batches, "conv_id", "group"):
            total, step = _total(mine), piece_steps([_by_entry(p["derivations"]) for p in mine])
            entries = sorted({d["entry"] for d in mine[0]["derivations"]})
            found = [d for q in entries for d in _table(q, step, len(mine))]
            yield {**{c: total.get(c) for c in schema.names}, "conv_id": conv, "piece": mine[0]["piece"],
                   "derivations": found}

    shift = 0
    while True:
        most = pieces.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
        if most <= FAN:
            return pieces
        shift += FAN_BITS
        dealt = pieces.withColumn("group", F.shiftright("piece", shift))
        pieces = handover(_mapped(dealt, join, schema, ["conv_id", "group"], "piece"), "conversation-pieces")


def _verdicts(pieces: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, and the goal item's weight."""
    id_type = pieces.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", id_type)])
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("audit", T.StringType())

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (conv,), mine in grouped(batches, "conv_id"):
            total, step = _total(mine), piece_steps([_by_entry(p["derivations"]) for p in mine])
            ((cost, audit),) = agenda(EMPTY, step, len(mine), GOALS).values()
            low = total["min_turn"]
            gaps = 0 if low is None else total["max_turn"] - low + 1 - total["distinct_turns"]
            yield {"conv_id": conv, "gaps": gaps, "cost": cost, "audit": audit, **{c: total[c] for c in COUNTS[1:]}}

    return _mapped(pieces, finish, schema, ["conv_id"], "piece")


def find_repairs(convs: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation of ``convs``."""
    return _verdicts(_merged(_pieces(_repeats(_ordered(_messages(convs))))))


def _stream(convs: DataFrame, repairs: DataFrame) -> DataFrame:
    """Each conversation's repair, then its messages in order, dealt by conversation and sorted in place."""
    texts = (_messages(convs).where("copies > 0")
             .select("conv_id", F.lit(1).alias("part"), "turn", "role", "digest", "text", "copies",
                     *(F.lit(None).cast(f.dataType).alias(f.name) for f in repairs.schema.fields[1:])))
    heads = repairs.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"),
                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
                           F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"),
                           *(c for c in repairs.columns[1:]))
    return (heads.unionByName(texts).repartition(width(convs.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "part", *_order()))


def edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, str | None, str | None]]:
    """(repair, role, text) of every message that stays or is put in; (repair, None, None) first of each."""
    head, letters, at, state = None, "", 0, EMPTY

    def put_in(until: int) -> Iterator[tuple[dict, str, str]]:
        nonlocal at, state
        while at < until and letters[at] == "I":
            role = "a" if state == USER else "u"
            state, at = MOVES[state, role], at + 1
            yield head, ROLE_OF[role], ""

    for batch in batches:
        for row in batch.to_pylist():
            if not row["part"]:
                if head is not None:
                    yield from put_in(len(letters))
                head, letters, at, state = row, row["audit"], 0, EMPTY
                yield head, None, None
                continue
            for _ in range(row["copies"]):
                yield from put_in(len(letters))
                edit, at = letters[at], at + 1
                if edit == "D":
                    continue
                role = row["role"][:1] if edit == "K" else "a" if state == USER else "u"
                state = MOVES[state, role]
                yield head, row["role"] if edit == "K" else ROLE_OF[role], row["text"]
    if head is not None:
        yield from put_in(len(letters))


def repaired_messages(convs: DataFrame, repairs: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (from 0), role, text."""
    schema = T.StructType([T.StructField("conv_id", repairs.schema["conv_id"].dataType),
                           T.StructField("place", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        place = 0
        for head, role, text in edited(batches):
            if role is None:
                place = 0
                continue
            yield {"conv_id": head["conv_id"], "place": place, "role": role, "text": text}
            place += 1

    return _stream(convs, repairs).mapInArrow(lambda batches: _batches(run(batches), schema), schema)


def repair_conversations(convs: DataFrame) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired text of every conversation.

    Rows may bring ``copies`` (0: the row is gone but its conversation is still
    returned). Rows of a conversation go by turn (nulls first), then role, then
    digest of the text; equal rows lie side by side. A null role or text is one
    space; a null conv_id is a conversation of its own. An initial other than s,
    u, a, or an empty role, which has none, can only be reroled or deleted. Very long texts pass as they are; an
    empty table gives no rows; further columns are ignored.

    Thin rows (no texts) are ordered and parsed; texts move once, for the digest.
    A SHA-256 of a whole conversation is sequential, so its texts pass through
    one task, as a stream of which a batch is held.
    """
    repairs = find_repairs(convs)
    schema = T.StructType([*repairs.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    names = repairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, said in itertools.groupby(edited(batches), lambda e: e[0]["conv_id"]):
            digest, begun = hashlib.sha256(), False
            for head, role, text in said:
                if role is not None:
                    digest.update((("\n" if begun else "") + role + ":").encode())
                    digest.update(text.encode())
                    begun = True
            yield {**{c: head[c] for c in names}, "repaired_sha256": digest.hexdigest()}

    return _stream(convs, repairs).mapInArrow(lambda batches: _batches(run(batches), schema), schema)
