"""Operator 7: sampled SentencePiece segmentations, and lossless decoding."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the public piece model lies; a parameter of every function that reads it.
MODEL = os.environ.get("EQUITAS_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
#: Bytes of text whose lattice a task holds at a time (a longer text is held alone).
BYTES_AT_ONCE = 1 << 21
#: Units up to this length are filtered side by side; longer ones one at a time.
WIDE = 40
#: Smoothing of the piece distribution: 1 samples from it, larger is sharper.
SHARPNESS = 1.0
BLANK = "▁"
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
STEP = np.uint64(0x100000001B3)
#: Resolution of a drawn number.
DRAWS = 1 << 32


class Pieces:
    """Pieces of a model as plain strings with log-probabilities, read from its serialised bytes.

    A merge model has ranks, not probabilities, so piece of rank r gets
    probability in proportion to 1 / (r + 10). Bytes stand for what no piece
    covers; they are less likely than any piece.
    """

    def __init__(self, serialised: bytes):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_proto=serialised)
        self.text: list[bytes] = [b""] * model.get_piece_size()
        self.byte = [0] * 256
        self.ids: dict[str, int] = {}
        plain = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value], self.text[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append((-model.get_score(i), i, piece.replace(BLANK, " ")))
        weight = {i: 1.0 / (r + 10) for r, (_, i, _) in enumerate(sorted(plain))}
        whole = sum(weight.values())
        self.logp = np.full(model.get_piece_size(), np.log(0.1 / (len(plain) + 10) / whole))
        for _, i, piece in plain:
            self.ids[piece], self.text[i] = i, piece.encode("utf-8")
            self.logp[i] = np.log(weight[i] / whole)
        self.longest = max(map(len, self.ids), default=1)
        # A cut is exact where no piece can span it. No piece holds a blank after another
        # character, and some characters occur in no piece beside others.
        inner = any(" " in p.lstrip(" ") for p in self.ids)
        joined = set("".join(p for p in self.ids if len(p) > 1))
        alone = "".join(c for c in map(chr, range(1, 32)) if c not in joined)
        self.units = re.compile("(?s).+" if inner else
                                f" *[^ {re.escape(alone)}]+| +|[{re.escape(alone)}]" if alone else " *[^ ]+| +")
        self.table, self.extra = self._prefix_tables()

    def _prefix_tables(self) -> tuple:
        """Beginnings of pieces by hash: which go on, and which are pieces (id; else -1).

        The first table has the hashes with a slot of their own, the other is
        sorted and has the few that share one.
        """
        known: dict[int, int] = {}
        for p, i in self.ids.items():
            h = 0
            for n, c in enumerate(p, 1):
                h = (h * int(STEP) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                known[h] = i if n == len(p) else known.get(h, -1)
        hashed = np.fromiter(known, np.uint64, len(known))
        ident = np.fromiter(known.values(), np.int64, len(known))
        slot = self._slot(hashed)
        _, first = np.unique(slot, return_index=True)
        keys, values = np.zeros(1 << 20, np.uint64), np.full(1 << 20, -2, np.int64)
        keys[slot[first]], values[slot[first]] = hashed[first], ident[first]
        rest = np.setdiff1d(np.arange(len(hashed)), first)
        rest = rest[np.argsort(hashed[rest])]
        shared = np.zeros(1 << 20, bool)
        shared[slot[rest]] = True
        return (keys, values, shared), (hashed[rest], ident[rest])

    @staticmethod
    def _slot(hashed: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((hashed * M1) >> np.uint64(44)).astype(np.int64)

    def look_up(self, hashed: np.ndarray) -> np.ndarray:
        """Id of the piece, -1 for a beginning that is none, -2 for what no piece begins with."""
        keys, values, shared = self.table
        slot = self._slot(hashed)
        out = np.where(keys[slot] == hashed, values[slot], -2)
        more = np.flatnonzero((out == -2) & shared[slot])
        if len(more):
            others, ident = self.extra
            at = np.minimum(np.searchsorted(others, hashed[more]), len(others) - 1)
            out[more] = np.where(others[at] == hashed[more], ident[at], -2)
        return out

    def fallback(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode("utf-8", "surrogatepass")]

    def decode(self, ids) -> str:
        """The text of a segmentation, without the blank that encoding puts first."""
        return b"".join([self.text[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


class Lattice:
    """Edges of many units: by node in order, with cumulative sampling probabilities.

    Node 0 of a unit is its start. For every later node the edges that end there
    carry the forward-filtered probability of having come that way, summed up and
    in whole numbers, so a sample is drawn backward from the last node, one edge at a time.
    """

    def __init__(self, pieces: Pieces, units: list[str], sharpness: float):
        size = np.fromiter(map(len, units), np.int64, len(units))
        self.base = np.cumsum(size + 1) - (size + 1)
        self.last = self.base + size
        alpha = np.full(int(size.sum()) + len(units), -np.inf)
        alpha[self.base] = 0
        self.bytes: list[list[int]] = []          # id -1 - k stands for the bytes self.bytes[k]
        self.byte_place: dict[str, int] = {}
        found = []
        short = np.flatnonzero(size <= WIDE)
        for top in (8, 16, WIDE):                 # units of like lengths side by side
            group = short[(size[short] <= top) & ((size[short] > top // 2) | (top == 8))] if top < WIDE else \
                short[size[short] > 16]
            if len(group):
                found.append(self._side_by_side(pieces, [units[i] for i in group], self.base[group],
                                                size[group], sharpness, alpha))
        for i in np.flatnonzero(size > WIDE):
            found.append(self._alone(pieces, units[i], int(self.base[i]), sharpness, alpha))
        start, end, ident, value = (np.concatenate([f[k] for f in found]) for k in range(4))
        del found
        # edges of a node stand by length, whatever else the batch holds
        order = np.argsort(end * 64 + np.minimum(end - start, 63))
        self.start, self.ident, end = start[order], ident[order], end[order]
        weight = np.exp(alpha[self.start] + value[order] - alpha[end])
        begins = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
        many = np.diff(np.append(begins, len(end)))
        self.first = np.zeros(len(alpha), np.int64)
        self.first[end[begins]] = begins
        # summed node by node, so a node's numbers do not depend on its neighbours
        for rank in range(1, int(many.max())):
            at = begins[many > rank] + rank
            weight[at] += weight[at - 1]
        self.below = np.minimum(weight * float(DRAWS), DRAWS).astype(np.int64)
        self.below[begins + many - 1] = DRAWS      # the last edge of a node takes what rounding leaves

    def back(self, node: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """The edge into each node that a number in 0 .. DRAWS - 1 chooses."""
        edge = self.first[node]
        on = np.flatnonzero(self.below[edge] <= draw)
        while len(on):
            edge[on] += 1
            on = on[self.below[edge[on]] <= draw[on]]
        return edge

    def _byte_edge(self, pieces: Pieces, char: str) -> tuple[int, float]:
        place = self.byte_place.get(char)
        if place is None:
            place = self.byte_place[char] = len(self.bytes)
            self.bytes.append(pieces.fallback(char))
        return -1 - place, float(pieces.logp[self.bytes[place]].sum())

    def _side_by_side(self, pieces, units, base, size, sharpness, alpha):
        n, top = len(units), int(size.max())
        code = np.zeros((top, n), np.uint64)
        flat = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(n), size)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        code[col, row] = flat
        edges = [[] for _ in range(top + 1)]       # by end
        for i in range(top):
            live = here = np.flatnonzero(size > i)
            hashed = np.zeros(len(live), np.uint64)
            covered = np.zeros(len(live), bool)
            for length in range(1, min(pieces.longest, top - i) + 1):
                if length > 1:
                    on = (got > -2) & (size[here] >= i + length)       # only what a piece begins with
                    here, hashed = here[on], hashed[on]
                    if not len(here):
                        break
                hashed = hashed * STEP + code[i + length - 1, here] + np.uint64(1)
                got = pieces.look_up(hashed)
                hit = got >= 0
                if length == 1:
                    covered = hit
                if hit.any():
                    ident = got[hit]
                    edges[i + length].append((here[hit], i, ident, pieces.logp[ident] * sharpness))
            bare = live[~covered]
            if len(bare):
                drawn = [self._byte_edge(pieces, units[j][i]) for j in bare.tolist()]
                edges[i + 1].append((bare, i, np.array([d[0] for d in drawn]),
                                     np.array([d[1] for d in drawn]) * sharpness))
        out = []
        for j in range(1, top + 1):
            for who, i, ident, value in edges[j]:
                to, frm = base[who] + j, base[who] + i
                alpha[to] = np.logaddexp(alpha[to], alpha[frm] + value)
                out.append((frm, to, ident, value))
        return [np.concatenate([o[k] for o in out]) for k in range(4)]

    def _alone(self, pieces, unit, base, sharpness, alpha):
        start, end, ident, value = [], [], [], []
        into: list[list[int]] = [[] for _ in range(len(unit) + 1)]
        for i in range(len(unit)):
            single = False
            for j in range(i + 1, min(len(unit), i + pieces.longest) + 1):
                k = pieces.ids.get(unit[i:j])
                if k is not None:
                    single |= j == i + 1
                    into[j].append(len(start))
                    start.append(i), end.append(j), ident.append(k), value.append(pieces.logp[k] * sharpness)
            if not single:
                k, v = self._byte_edge(pieces, unit[i])
                into[i + 1].append(len(start))
                start.append(i), end.append(i + 1), ident.append(k), value.append(v * sharpness)
        own = [0.0] + [0.0] * len(unit)
        for j in range(1, len(unit) + 1):
            terms = [own[start[e]] + value[e] for e in into[j]]
            top = max(terms)
            own[j] = top + float(np.log(sum(np.exp(t - top) for t in terms)))
        alpha[base:base + len(unit) + 1] = own
        return (np.array(start) + base, np.array(end) + base, np.array(ident), np.array(value))


def draws(seed: np.ndarray, unit: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Numbers in 0 .. DRAWS - 1 that a row's seed, the unit's place in it and the node decide."""
    with np.errstate(over="ignore"):
        x = seed + unit.astype(np.uint64) * M1 + (node.astype(np.uint64) + np.uint64(1)) * M3
        x = (x ^ (x >> np.uint64(30))) * M2
        x = (x ^ (x >> np.uint64(27))) * M3
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(32)).astype(np.int64)


def sample_texts(pieces: Pieces, texts: list[str], seeds: list[int],
                 sharpness: float = SHARPNESS) -> tuple[np.ndarray, np.ndarray]:
    """One sampled segmentation per text: all piece ids one after another, and how many each text has."""
    found = [pieces.units.findall(" " + t) if t else [] for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    every = [u for f in found for u in f]
    if not every:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    place: dict[str, int] = {u: i for i, u in enumerate(dict.fromkeys(every))}
    lattice = Lattice(pieces, list(place), sharpness)
    which = np.fromiter(map(place.__getitem__, every), np.int64, len(every))
    seed = np.repeat(np.array(seeds, np.uint64), counts)
    ordinal = np.arange(len(every)) - np.repeat(np.cumsum(counts) - counts, counts)
    base, node = lattice.base[which], lattice.last[which]
    at = np.arange(len(every))
    steps, length = [], np.zeros(len(every), np.int64)
    while len(at):
        edge = lattice.back(node, draws(seed[at], ordinal[at], node - base[at]))
        steps.append((at, lattice.ident[edge].astype(np.int32), length[at].astype(np.int32)))
        length[at] += 1
        node = lattice.start[edge]
        on = node > base[at]
        at, node = at[on], node[on]
    first = np.cumsum(length) - length
    ids = np.zeros(int(length.sum()), np.int64)
    for who, ident, step in steps:                # drawn from the end backward
        ids[first[who] + length[who] - 1 - step] = ident
    per_text = np.bincount(np.repeat(np.arange(len(texts)), counts), weights=length,
                           minlength=len(texts)).astype(np.int64)
    if lattice.bytes and (ids < 0).any():
        wide = np.ones(len(ids), np.int64)
        low = ids < 0
        wide[low] = np.array([len(b) for b in lattice.bytes])[-1 - ids[low]]
        text_of = np.repeat(np.arange(len(texts)), per_text)
        full = np.repeat(ids, wide)
        rank = np.arange(len(full)) - np.repeat(np.cumsum(wide) - wide, wide)
        widest = max(map(len, lattice.bytes))
        table = np.array([b + [0] * (widest - len(b)) for b in lattice.bytes])
        low = full < 0
        full[low] = table[-1 - full[low], rank[low]]
        per_text = np.bincount(text_of, weights=wide, minlength=len(texts)).astype(np.int64)
        ids = full
    return ids.astype(np.int32), per_text


def serialised(path: str) -> bytes:
    """The model file's bytes; tasks get them by broadcast (some 0.5 MB), not by path."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, seed: int = 0, sharpness: float = SHARPNESS, model: str = MODEL,
           key: str | Column = "doc_id") -> DataFrame:
    """Sample one segmentation of every whole text from the piece lattice.

    Texts are cut into units that no piece can span. For each distinct unit the
    lattice is filtered forward: every node gets the total probability of all
    ways to it. For each occurrence a path is drawn backward from the end. The
    random numbers come from ``seed``, the row's key, the unit's place and the
    node alone, so reruns, other partitionings and lost executors give the same
    pieces; rows of equal key and text get equal ones.

    Returns doc_id, ids (null for a null text, empty for an empty one), n_pieces
    (0 for either), n_bytes (UTF-8) and lossless (whether decoding the ids gives
    the text back; null text: true). A null key counts as ''. Texts of any
    length and any characters are encoded; bytes stand for characters that no
    piece has, and for a literal U+2581. Repeated rows are each returned; an
    empty table gives no rows; further columns are ignored.
    """
    proto = docs.sparkSession.sparkContext.broadcast(serialised(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(proto.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, i = np.cumsum(sizes), 0
            while i < len(sizes):                  # as many texts as fit, and one at least
                j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + BYTES_AT_ONCE, "right")))
                part = batch.slice(i, j - i)
                texts = [t or "" for t in part.column(1).to_pylist()]
                seeds = [xxhash.xxh64_intdigest(f"{seed}:{k}".encode()) for k in part.column(2).to_pylist()]
                ids, counts = sample_texts(pieces, texts, seeds, sharpness)
                at = np.concatenate(([0], np.cumsum(counts)))
                back = [pieces.decode(ids[a:b].tolist()) == t for t, a, b in zip(texts, at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()),
                                              mask=pc.is_null(part.column(1))),
                     pa.array(counts, pa.int64()), pa.array(sizes[i:j], pa.int64()), pa.array(back, pa.bool_())],
                    ["doc_id", "ids", "n_pieces", "n_bytes", "lossless"])
                i = j

    own = F.col(key) if isinstance(key, str) else key
    thin = docs.select("doc_id", "text", F.coalesce(own.cast("string"), F.lit("")).alias("_key"))
    kind = thin.schema["doc_id"].dataType.simpleString()
    return thin.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_pieces long, n_bytes long, lossless boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text for rows of (doc_id, ids): exactly what was encoded (null ids: null)."""
    proto = encoded.sparkSession.sparkContext.broadcast(serialised(model))

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = Pieces(proto.value)
        for rows in columns:
            yield pd.Series([None if ids is None else pieces.decode(ids.tolist()) for ids in rows], dtype=object)

    back = F.pandas_udf(run, "string")
    return encoded.select("doc_id", back("ids").alias("text"))
