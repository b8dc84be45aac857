"""Sampled segmentations of texts into SentencePiece pieces, and their lossless decoding (op5).

A text is a lattice: positions between its characters, and an edge for each vocabulary piece
that stands there (bytes for a character without a piece). Forward filtering sums, per
position, the weight of all ways to reach it; backward sampling walks from the end, choosing
among the edges that end at a position in proportion to the sum at their start times their
weight. A piece's weight falls with its rank in the vocabulary, by a power law.

No piece spans a place where two neighbouring characters stand in no piece side by side, so
the lattice falls into parts there, and a worker keeps the filtered lattices of the parts it
has met. All parts of some texts are sampled at once, step by step. The random numbers are a
hash of the row's key, the part's place in the text and the step: a row gets the same pieces
whatever task, batch or attempt it is in.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.llm.common import quoted

# The power of the weights' law; the seed of all draws.
ALPHA, SEED = 1.0, 5
# About the inverse of a piece's weight per character; it has no effect on the draws.
SCALE = 40.0
# Of the hash by which beginnings of pieces are found; 64 bits, so a false hit is not to be expected.
FACTOR = 0x9E3779B97F4A7C15
# Edges kept by a worker, and characters of text sampled at once.
EDGES, CHARACTERS = 4_000_000, 1 << 19
# The mark of a blank in a piece.
BLANK = "▁"
_CHUNK = re.compile(r" *[^ \n]+| +|\n")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in sorted keys, and whether they are there."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


class Vocabulary:
    """The usable pieces, in arrays that are searched by hashes of all beginnings of pieces."""

    def __init__(self, path: str, alpha: float):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.byte_ids, self.raw = [0] * 256, [b""] * model.get_piece_size()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.raw[i] = piece.replace(BLANK, " ").encode()
                # Blanks and their runs have a score far under all others, and the last rank.
                self.pieces[piece] = i, (2 + min(-model.get_score(i), model.get_piece_size())) ** -alpha * SCALE ** len(piece)
        self.longest = max(map(len, self.pieces), default=1)
        self.singles = np.unique(_codes("".join(p for p in self.pieces if len(p) == 1)))
        pairs = "".join(p[k : k + 2] for p in self.pieces for k in range(len(p) - 1))
        self.pairs = np.unique((_codes(pairs[::2]) << np.uint64(21)) | _codes(pairs[1::2]))
        beginnings: dict[int, tuple[int, float]] = {}
        for p, own in self.pieces.items():
            h = 0
            for c in p[:-1]:
                h = (h * FACTOR + ord(c) + 1) % (1 << 64)
                beginnings.setdefault(h, (-1, 0.0))
            beginnings[(h * FACTOR + ord(p[-1]) + 1) % (1 << 64)] = own
        self.hashes = np.array(sorted(beginnings), np.uint64)
        self.ids = np.array([beginnings[int(h)][0] for h in self.hashes], np.int32)
        self.weights = np.array([beginnings[int(h)][1] for h in self.hashes])

    def edges(self, codes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in a row of characters, of which ``room`` follow in the same part: place, length, id, weight."""
        found, at, h = [], np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        for n in range(1, self.longest + 1):
            more = room[at] >= n
            at, h = at[more], h[more]
            h = h * np.uint64(FACTOR) + codes[at + n - 1] + np.uint64(1)
            place, there = _find(self.hashes, h)
            at, h, place = at[there], h[there], place[there]
            if not len(at):
                break
            piece = self.ids[place] >= 0
            found.append((at[piece], np.full(piece.sum(), n), self.ids[place[piece]], self.weights[place[piece]]))
        return tuple(np.concatenate(x) for x in zip(*found))


class Sampler:
    """Lattices of the chunks met, as arrays over all their edges in the order of the nodes they end at.

    ``sums`` holds, for each edge, its end node plus the summed shares of the edges that end
    there, up to its own; ``first`` the first of these edges for each node. The first nodes
    are those of the 256 bytes.
    """

    def __init__(self, path: str, alpha: float = ALPHA):
        self.vocabulary = Vocabulary(path, alpha)
        self._forget()

    def _forget(self) -> None:
        self.chunks: dict[str, bytes] = {}
        self.next = 256
        self.sums, self.starts = np.arange(256) + 1.0, np.full(256, -1, np.int32)
        self.ids = np.array(self.vocabulary.byte_ids, np.int32)
        self.first = np.arange(256, dtype=np.int32)

    def _learn(self, chunks: list[str]) -> None:
        """Lattices of chunks, all at once, position by position."""
        v, text = self.vocabulary, "".join(chunks)
        codes = _codes(text)
        codes = np.where(codes == ord(" "), ord(BLANK), np.where(codes == ord(BLANK), 0, codes)).astype(np.uint64)
        owner = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        _, own = _find(v.singles, codes)
        first = np.ones(len(codes), bool)
        _, beside = _find(v.pairs, (codes[:-1] << np.uint64(21)) | codes[1:])
        first[1:] = ~(own[1:] & own[:-1] & beside & (owner[1:] == owner[:-1]))
        starts = np.flatnonzero(first)
        lengths = np.diff(np.append(starts, len(codes)))
        # Nodes of a part: one before each character and one behind the last.
        base = self.next + np.cumsum(lengths + 1) - lengths - 1
        part = np.repeat(np.arange(len(starts)), lengths)
        inside = np.arange(len(codes)) - starts[part]
        place, size, ids, weights = v.edges(codes, np.where(own, lengths[part] - inside, 0))
        end = inside[place] + size
        target = base[part[place]] + end
        order = np.lexsort((size, target, end))
        place, size, ids, weights, end, target = (x[order] for x in (place, size, ids, weights, end, target))
        source = target - size
        reached = np.zeros(int(lengths.sum()) + len(lengths))
        shift = self.next
        reached[base - shift] = 1.0
        shares = np.empty(len(place))
        edges = np.searchsorted(end, np.arange(1, lengths.max() + 2))
        for distance, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist()), 1):
            # All edges that end at one distance from their part's first node.
            into = target[a:b] - shift
            here = reached[source[a:b] - shift] * weights[a:b]
            np.add.at(reached, into, here)
            shares[a:b] = here / reached[into]
            total = reached[into]
            if len(into) and not (total.min() > 1e-100 and total.max() < 1e100):
                # Sums of a part that run out of the range of numbers are divided by the newest.
                odd = np.unique(into[(total <= 1e-100) | (total >= 1e100)])
                newest = reached[odd]
                for back in range(min(distance + 1, v.longest)):
                    reached[odd - back] /= newest
        order = np.lexsort((size, target))
        target, ids, inner, shares = target[order], ids[order], (inside[place] > 0)[order], shares[order]
        begin = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(target) else np.zeros(0, int)
        counts = np.diff(np.append(begin, len(target)))
        for k in range(1, counts.max(initial=0)):
            at = begin[counts > k] + k
            shares[at] += shares[at - 1]
        if len(begin):
            shares[begin + counts - 1] = 1.0
        first = np.zeros(len(reached), np.int32)
        first[target[begin] - shift] = begin + len(self.sums)
        self.first = np.concatenate([self.first, first])
        self.sums = np.concatenate([self.sums, target + shares])
        self.starts = np.concatenate([self.starts, np.where(inner, target - size[order], -1).astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        self.next += int(lengths.sum()) + len(lengths)
        # The last node of each part; a character without a piece is the parts of its bytes.
        last, pieces = base + lengths, np.ones(len(starts), np.int64)
        lone = np.flatnonzero(~own[starts])
        raw = [text[i].encode() for i in starts[lone].tolist()]
        pieces[lone] = [len(r) for r in raw]
        nodes = np.repeat(last, pieces)
        nodes[np.repeat(~own[starts], pieces)] = np.frombuffer(b"".join(raw), np.uint8)
        per_chunk = np.bincount(owner[starts], pieces, len(chunks)).astype(np.int64)
        packed, ends = nodes.astype("<i8").tobytes(), np.cumsum(per_chunk) * 8
        for chunk, a, b in zip(chunks, (ends - per_chunk * 8).tolist(), ends.tolist()):
            self.chunks[chunk] = packed[a:b]

    def sample(self, keys: list, texts: list[str]) -> list[np.ndarray]:
        """The piece ids of each text."""
        if len(self.sums) > EDGES:
            self._forget()
        known, found = self.chunks, []
        for text in texts:
            found.append(_CHUNK.findall(" " + text) if text else [])
        new = [c for c in set().union(*found) if c not in known]
        if new:
            self._learn(sorted(new))
        nodes = [np.frombuffer(b"".join(map(known.__getitem__, f)), "<i8") for f in found]
        seeds = np.array([xxhash.xxh64_intdigest(repr(k).encode(), SEED) for k in keys], np.uint64)
        counts = np.array([len(n) for n in nodes])
        at = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        draws = _mixed(np.repeat(seeds, counts) + _mixed(place.astype(np.uint64)))
        alive, steps, step = np.arange(len(at)), [], 0
        lengths = np.zeros(len(at), np.int64)
        while len(alive):
            u = (_mixed(draws[alive] + np.uint64(step)) >> np.uint64(34)).astype(np.float64) * 2.0**-30
            edge, draw = self.first[at[alive]], at[alive] + u
            low = np.flatnonzero(self.sums[edge] <= draw)
            while len(low):
                edge[low] += 1
                low = low[self.sums[edge[low]] <= draw[low]]
            steps.append((alive, self.ids[edge]))
            lengths[alive] += 1
            at[alive] = self.starts[edge]
            alive = alive[at[alive] >= 0]
            step += 1
        ends = np.cumsum(lengths)
        out = np.empty(ends[-1] if len(ends) else 0, "<u4")
        for step, (rows, ids) in enumerate(steps):
            out[ends[rows] - 1 - step] = ids
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [out[a:b] for a, b in zip(edges, edges[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a segmentation: the pieces' bytes, less the blank that every text begins with."""
        return b"".join(map(self.vocabulary.raw.__getitem__, ids.tolist()))[1:].decode()


@lru_cache(2)
def sampler(path: str, alpha: float) -> Sampler:
    return Sampler(path, alpha)


def _sampled(path: str, alpha: float, keys: list, texts: list[str | None]):
    """Segmentations of texts, some at a time."""
    start, of = 0, sampler(path, alpha)
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (size < CHARACTERS or stop == start):
            size += len(texts[stop] or "")
            stop += 1
        yield from of.sample(keys[start:stop], [t or "" for t in texts[start:stop]])
        start = stop


def sampled_ids(key: Column, text: Column, path: str, alpha: float = ALPHA) -> Column:
    """Ids of a sampled segmentation, as binary of little-endian 32-bit integers; of a null text none."""

    @F.arrow_udf("binary")
    def encode(keys: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([ids.tobytes() for ids in _sampled(path, alpha, keys.to_pylist(), texts.to_pylist())], pa.binary())

    return encode(key, text)


def decoded(ids: Column, path: str) -> Column:
    """The text of ids from ``sampled_ids`` or the library; null stays null."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        of = sampler(path, ALPHA)
        return pa.array([None if r is None else of.decode(np.frombuffer(r, "<u4")) for r in rows.to_pylist()], pa.string())

    return decode(ids)


def round_trips(df: DataFrame, path: str, alpha: float = ALPHA, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_pieces, ids_crc32 (of little-endian 32-bit ids), and lossless (the ids decode to the whole text).

    A null or empty text has no pieces. Rows that repeat get equal pieces, as they have equal
    keys; a null key is a key like any other. An empty table gives no row.
    """

    @F.arrow_udf("struct<ids: binary, text: string>")
    def both(keys: pa.Array, texts: pa.Array) -> pa.Array:
        of, rows = sampler(path, alpha), []
        for ids in _sampled(path, alpha, keys.to_pylist(), texts.to_pylist()):
            rows.append({"ids": ids.tobytes(), "text": of.decode(ids)})
        return pa.array(rows, pa.struct([("ids", pa.binary()), ("text", pa.string())]))

    found = df.select(quoted(key).alias(key), quoted(text).alias("__text"), both(quoted(key), quoted(text)).alias("__s"))
    same = F.col("__s.text") == F.coalesce("__text", F.lit(""))
    return found.select(key, (F.octet_length("__s.ids") / 4).cast("long").alias("n_pieces"), F.crc32("__s.ids").alias("ids_crc32"), same.alias("lossless"))
