"""Operator 9: token sequences in training order, in fixed-stride shards."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import remove
from .handover import handover, new_folder, only

#: Where the public vocabulary lies; a parameter of every function that reads it.
VOCABULARY = os.environ.get("EQUITAS_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: how the vocabulary's own tokenizer cuts a text before it merges bytes.
PATTERN = (r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Ends every document; the first id that the vocabulary leaves free.
END = 50_256
#: Tokens per sequence and sequences per shard.
LENGTH, SHARD_SLOTS = 1024, 8192
ROUNDS = 6
#: Parts in which the shards are dealt and written, so that only one part's shuffle lies on disk.
SHARES = 4


class Tokens:
    """The byte-level tokenizer of a rank file."""

    def __init__(self, ranks: bytes):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text or "") + [END], np.uint16)


def feistel(index: np.ndarray, size: int, key: str, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1.

    A balanced Feistel network permutes the smallest even number of bits that
    holds ``size``; what falls outside is put through it again (cycle-walking)
    until it falls inside, fewer than four times on average.
    """
    half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "little"))
            for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << half) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """Sequences of ``length`` tokens from the documents of each partition, one after another.

    Every document ends with END, and a sequence may hold the end of one and the
    start of the next; the last one of a partition is filled up with END. One
    row per sequence: run (partition), place in it, n_tokens, doc_ids in order,
    and the ids as compressed little-endian 16-bit numbers.
    """
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())      # some 1 MB

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, press = Tokens(ranks.value), zstandard.ZstdCompressor(level=3)
        held: list[np.ndarray] = []                 # not yet in a sequence
        ends: list[tuple[int, int | None]] = []     # (tokens so far, document), of those held
        have, place, rows = 0, 0, []
        part = None

        def cut(all_of_it: bool) -> None:
            nonlocal held, ends, have, place
            stream = np.concatenate(held) if held else np.zeros(0, np.uint16)
            stop = len(stream) if all_of_it else len(stream) // length * length
            docs_at = np.array([e for e, _ in ends], np.int64)
            for a in range(0, stop, length):
                ids = stream[a:a + length]
                n = len(ids)
                if n < length:
                    ids = np.append(ids, np.full(length - n, END, np.uint16))
                lo, hi = np.searchsorted(docs_at, a, "right"), np.searchsorted(docs_at, a + n, "left")
                rows.append((part, place, n, [d for _, d in ends[lo:hi + 1]],
                             press.compress(ids.astype("<u2").tobytes())))
                place += 1
            ends = [(e - stop, d) for e, d in ends if e > stop]
            held, have = [stream[stop:]], len(stream) - stop

        def out() -> pd.DataFrame:
            nonlocal rows
            frame = pd.DataFrame(rows, columns=["run", "place", "n_tokens", "doc_ids", "packed"])
            rows = []
            return frame

        for batch in batches:
            part = int(batch["_part"].iloc[0]) if len(batch) else part
            for doc, text in zip(batch["id"], batch["text"]):
                ids = tokens.encode(text)
                held.append(ids)
                have += len(ids)
                ends.append((have, None if doc is None else int(doc)))
                if have >= 64 * length:
                    cut(False)
                    yield out()
        cut(True)
        yield out()

    thin = only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("string").alias("id"), "text", F.spark_partition_id().alias("_part"))
    return thin.mapInPandas(run, "run int, place long, n_tokens int, doc_ids array<long>, packed binary")


def training_order(docs: DataFrame, key: str = "order", length: int = LENGTH, shard_slots: int = SHARD_SLOTS,
                   vocabulary: str = VOCABULARY) -> DataFrame:
    """All token sequences at their places in the training order, shard by shard.

    Sequences are numbered by partition and place (the numbers of all partitions
    before, from one count per partition, plus the place), and the keyed Feistel
    permutation turns that index into a global slot. Shard s holds slots s x
    shard_slots onward; it is one partition, in slot order, and its records have
    one size, so ``write_shards`` puts slot k at byte (k mod shard_slots) x (2 x
    length + 1), its offset.

    Returns shard, slot, offset, index, n_tokens (without filling), doc_ids
    (documents with tokens in it, null ids included), record (little-endian
    16-bit ids), record_crc32. A null text counts as empty: a document of the
    end mark only. Repeated rows are each materialised. An empty table gives no
    rows; further columns are ignored. The order is a pure function of the key
    and the input's partitions.

    Packed sequences are handed over once, so a lost executor does not renumber
    them; only compressed records are shuffled.
    """
    slotted, total = _slotted(docs, key, length, shard_slots, vocabulary)
    return _opened(slotted, 0, max(1, -(-total // shard_slots)), length, shard_slots)


def _slotted(docs: DataFrame, key: str, length: int, shard_slots: int, vocabulary: str,
             path: str | None = None) -> tuple[DataFrame, int]:
    """Packed sequences (handed over at ``path``) with index, slot and shard, and how many there are."""
    packed = handover(pack(docs, length, vocabulary), "sequences", path)
    runs = handover(packed.groupBy("run").count(), "runs")
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    base = runs.select("run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    total = runs.agg(F.sum("count")).first()[0] or 0

    @F.pandas_udf("long")
    def place(index: pd.Series) -> pd.Series:
        return pd.Series(feistel(index.to_numpy(), total, key))

    # one row per input partition
    numbered = packed.join(F.broadcast(base), "run").withColumn("index", F.col("first") + F.col("place"))
    return numbered.withColumn("slot", place("index")).withColumn(
        "shard", F.floor(F.col("slot") / shard_slots).cast("int")), total


def _offset(length: int, shard_slots: int) -> Column:
    return ((F.col("slot") % shard_slots) * (2 * length + 1)).alias("offset")


def _opened(slotted: DataFrame, first: int, stop: int, length: int, shard_slots: int) -> DataFrame:
    """The records of shards first .. stop - 1, each shard one partition in slot order."""
    here = slotted.where(F.col("shard").between(first, stop - 1))
    dealt = here.select("shard", "slot", "index", "n_tokens", "doc_ids", "packed").repartitionById(
        stop - first, F.col("shard") - first).sortWithinPartitions("slot")

    def open_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            yield batch.assign(record=[press.decompress(p) for p in batch["packed"]]).drop(columns="packed")

    opened = dealt.mapInPandas(
        open_, "shard int, slot long, index long, n_tokens int, doc_ids array<long>, record binary")
    return opened.select("shard", "slot", _offset(length, shard_slots), "index", "n_tokens", "doc_ids", "record",
                         F.crc32("record").alias("record_crc32"))


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files behind once it is done."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


def token_output(docs: DataFrame, key: str = "order", length: int = LENGTH, shard_slots: int = SHARD_SLOTS,
                 vocabulary: str = VOCABULARY, path: str | None = None, shares: int = SHARES) -> DataFrame:
    """Write the shards of ``training_order`` and return its rows, records read back from the files.

    The files lie under ``path``, a folder without shards so far; by default in
    this application's hand-over folder, which goes with the session. Columns,
    rows, partitions and their order are those of ``training_order``; a slot
    that the files lack is an error.

    Shards are dealt and written in ``shares`` parts, each without the shuffle
    files of the one before, and the packed sequences are removed once all are
    written. Records and the rest of their rows then meet in one shuffle by shard.
    """
    spark = docs.sparkSession
    sequences, path = new_folder(spark, "sequences"), path or new_folder(spark, "shards")
    with _shuffles_removed(spark):
        slotted, total = _slotted(docs, key, length, shard_slots, vocabulary, sequences)
        shards = -(-total // shard_slots)
        places = handover(slotted.select("shard", "slot", "index", "n_tokens", "doc_ids"), "places")
        edges = [shards * i // shares for i in range(shares + 1)]
        for first, stop in zip(edges, edges[1:]):
            if first < stop:
                write_shards(_opened(slotted, first, stop, length, shard_slots), path)
    remove(spark, sequences)
    schema = "shard int, slot long, index long, n_tokens int, doc_ids array<long>, record binary"
    if total:
        records = _records(spark, path, 0, total, length, shard_slots)
        both = places.withColumn("record", F.lit(None).cast("binary")).unionByName(records, allowMissingColumns=True)
        # of each slot first the row without, then the row with the record
        dealt = both.repartitionById(shards, F.col("shard")).sortWithinPartitions(
            "slot", F.col("record").isNotNull())
    else:
        dealt = spark.createDataFrame([], schema)

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            n = len(rows) // 2 * 2
            rest = rows.iloc[n:]
            row, read = rows.iloc[0:n:2], rows.iloc[1:n:2]
            if (row["slot"].to_numpy() != read["slot"].to_numpy()).any() or read["record"].isna().any():
                raise ValueError("the shard files do not hold each slot once")
            yield row.assign(index=row["index"].astype("int64"), n_tokens=row["n_tokens"].astype("int32"),
                             record=read["record"].to_numpy())
        if rest is not None and len(rest):
            raise ValueError("the shard files do not hold each slot once")

    return dealt.select("shard", "slot", "index", "n_tokens", "doc_ids", "record").mapInPandas(meet, schema).select(
        "shard", "slot", _offset(length, shard_slots), "index", "n_tokens", "doc_ids", "record",
        F.crc32("record").alias("record_crc32"))


def write_shards(ordered: DataFrame, path: str) -> None:
    """Write ``training_order`` as one binary file of fixed stride per shard, under path/shard=s.

    Slot k of a shard begins at byte (k mod shard_slots) x (2 x length + 1): its
    ids as little-endian 16-bit numbers, then a line feed. Spark's text writer
    puts the bytes out as they are and commits whole files to whatever store the
    path names. A shard is one partition, so a rerun can be given only the
    shards that are missing, and writes the same bytes.
    """
    (ordered.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
     .write.partitionBy("shard").mode("append").text(path))


def read_slots(spark: SparkSession, path: str, first: int, stop: int, length: int = LENGTH,
               shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(slot, record) of slots first .. stop - 1, in order: a reader that resumes at any slot.

    Only the shards in question are opened, one bounded file each, and each
    record is cut out by its offset. Slots beyond the last one give no rows.
    """
    return _records(spark, path, first, stop, length, shard_slots).select("slot", "record").orderBy("slot")


def _records(spark: SparkSession, path: str, first: int, stop: int, length: int, shard_slots: int) -> DataFrame:
    """(shard, slot, record) of slots first .. stop - 1, cut out of the shard files."""
    stride = 2 * length + 1
    files = spark.read.format("binaryFile").load(path).where(
        F.col("shard").between(first // shard_slots, max(first, stop - 1) // shard_slots))
    start = F.col("shard").cast("long") * shard_slots
    there = start + F.floor(F.col("length") / stride)
    slots = F.sequence(F.greatest(start, F.lit(first)), F.least(there, F.lit(stop)) - 1)
    some = F.greatest(start, F.lit(first)) < F.least(there, F.lit(stop))
    rows = files.where(some).select("shard", "content", F.explode(slots).alias("slot"))
    at = ((F.col("slot") % shard_slots) * stride + 1).cast("int")
    return rows.select("shard", "slot", F.substring("content", at, F.lit(2 * length)).alias("record"))
