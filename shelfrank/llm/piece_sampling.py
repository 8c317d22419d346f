"""Sampled SentencePiece segmentations: forward filtering, backward sampling.

All ways to cut a text into pieces of the vocabulary form a lattice. A path has
the weight exp(sum over its pieces of (alpha x score - piece_cost)). Forward
filtering adds up the weights of all paths to each position; backward sampling
draws, from the end, each last piece with its exact conditional probability. The
draws come from a counter-based generator seeded by the row's key, the unit's place
in the row and the place in the unit, so a row's segmentation does not depend on partitions,
batches or repeated attempts.

No piece holds a word mark after another character, so the lattice falls apart
before each run of marks. Units of a slice are made distinct, lattices of those
not met before are built together with numpy (a hashed trie, one step per piece
length), and the occurrences of all units are sampled in lockstep. A very long
unit, a text without spaces, is filtered in blocks instead.

Spaces become word marks, with one in front, as in SentencePiece; characters
outside the vocabulary, and word marks of the text itself, become byte pieces.
So decoding gives back every text exactly.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfrank.llm.common import fresh, ship, slices, texts

ship(__name__)

#: For vocabularies whose scores are negative merge ranks. Scores that are log
#: probabilities take alpha about 0.2 and no piece cost.
ALPHA = 1e-4
PIECE_COST = 3.0
SEED = 20
#: Characters from which a unit (a text without spaces, say) is sampled in blocks
#: of as many characters.
LONG_UNIT = 1 << 16
#: Characters of units whose lattices a task holds (about 100 bytes each).
HELD_CHARS = 2_000_000

MARK = "▁"
#: Stands for a word mark of the text itself; no UTF-8 text holds this code.
_OWN_MARK = "\udc81"
_UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a model file: a hashed trie for encoding, bytes for decoding."""

    def __init__(self, path: str, alpha: float = ALPHA, piece_cost: float = PIECE_COST):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_id = np.full(256, -1, np.int64)
        self.weight = np.zeros(size)
        children: list[dict[int, int]] = [{}]
        piece: list[int] = [-1]
        for i in range(size):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(text[1:-1], 16)] = i
                self.bytes[i] = bytes([int(text[1:-1], 16)])
                continue
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if MARK in text.lstrip(MARK):
                raise ValueError(f"piece {text!r} crosses a word boundary")
            self.bytes[i] = text.replace(MARK, " ").encode()
            self.weight[i] = alpha * sp.get_score(i) - piece_cost
            node = 0
            for ch in map(ord, text):
                if ch not in children[node]:
                    children[node][ch] = len(children)
                    children.append({})
                    piece.append(-1)
                node = children[node][ch]
            piece[node] = i
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        self.byte_weight = float(self.weight.min())
        self.longest = max(1, *(len(sp.id_to_piece(i)) for i in range(size)))
        if self.longest > 255:
            raise ValueError("a piece is longer than 255 characters")
        self.piece = np.array(piece, np.int64)
        edges = [(n << 21 | ch, child) for n, kids in enumerate(children) for ch, child in kids.items()]
        self._hash([k for k, _ in edges], [c for _, c in edges])

    def _hash(self, keys: list[int], values: list[int]) -> None:
        """An open-addressing table of at least four times the entries."""
        self.bits = max(4, (4 * len(keys)).bit_length())
        table = {}
        self.probes = 1
        for key, value in zip(keys, values):
            at = ((key * int(_ODD)) & ((1 << 64) - 1)) >> (64 - self.bits)
            probe = 1
            while at in table:
                at = (at + 1) & ((1 << self.bits) - 1)
                probe += 1
            table[at] = (key, value)
            self.probes = max(self.probes, probe)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int64)
        at = np.fromiter(table, np.int64, len(table))
        self.keys[at] = [k for k, _ in table.values()]
        self.values[at] = [v for _, v in table.values()]

    def step(self, node: np.ndarray, ch: np.ndarray) -> np.ndarray:
        """Child of each trie node by a character, -1 if there is none."""
        key = node << 21 | ch
        with np.errstate(over="ignore"):
            at = ((key.view(np.uint64) * _ODD) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[at] == key, self.values[at], -1)
        open_ = np.flatnonzero((out < 0) & (self.keys[at] != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            got = self.keys[at[open_]]
            same = got == key[open_]
            out[open_[same]] = self.values[at[open_[same]]]
            open_ = open_[~same & (got != -1)]
        return out

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 bytes of a segmentation's text."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _edges(v: Vocabulary, ch: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, piece, weight) of all pieces that begin at a character and
    end at `last` of it or before. A character without a piece of its own is
    spelled in bytes: piece -1 - code."""
    start, length, piece, plain = [], [], [], np.zeros(len(ch), bool)
    at, node, size = np.arange(len(ch)), np.zeros(len(ch), np.int64), 0
    while len(at):
        node = v.step(node, ch[at + size])
        size += 1
        alive = node >= 0
        at, node = at[alive], node[alive]
        found = v.piece[node]
        hit = found >= 0
        start.append(at[hit])
        length.append(np.full(len(start[-1]), size))
        piece.append(found[hit])
        if size == 1:
            plain[at[hit]] = True
        more = at + size < last[at]
        at, node = at[more], node[more]
    odd = np.flatnonzero(~plain)
    start.append(odd)
    length.append(np.ones(len(odd), np.int64))
    piece.append(-1 - ch[odd])
    start, length, piece = map(np.concatenate, (start, length, piece))
    n_bytes = 1 + (-1 - piece > 0x7F) + (-1 - piece > 0x7FF) + (-1 - piece > 0xFFFF)
    return start, length, piece, np.where(piece >= 0, v.weight[np.maximum(piece, 0)], n_bytes * v.byte_weight)


def _cumulated(chance: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Running sums of each node's edges (from heads[i] to heads[i + 1]), which
    depend on these alone; the last is infinite, so that no draw leads past it."""
    cum, degree = chance.copy(), np.diff(heads)
    for r in range(1, int(degree.max(initial=0))):
        at = heads[:-1][degree > r] + r
        cum[at] += cum[at - 1]
    cum[heads[1:][degree > 0] - 1] = np.inf
    return cum


class Lattices:
    """Lattices of some units. Each position of a unit is a node; edges end in
    their node, shortest first, with cumulated probabilities."""

    def __init__(self, vocabulary: Vocabulary, units: list[str]):
        ch = _codes("".join(units))
        self.length = np.array([len(u) for u in units], np.int64)
        unit = np.repeat(np.arange(len(units)), self.length)
        start = np.cumsum(self.length) - self.length
        self.first = start + np.arange(len(units))  # first node of each unit
        source, size, piece, weight = _edges(vocabulary, ch, (start + self.length)[unit])
        source = source + unit[source]  # as nodes
        target = source + size
        # Forward filtering, position by position over all units at once. Edges go
        # by the place of their node in its unit, then node, then size.
        n_nodes = len(ch) + len(units)
        place = np.arange(n_nodes) - np.repeat(self.first, self.length + 1)
        sizes = int(size.max(initial=0)) + 1
        order = np.argsort((place[target] * n_nodes + target) * sizes + size)
        source, target, piece, weight = source[order], target[order], piece[order], weight[order]
        total = np.zeros(n_nodes)
        edge = np.searchsorted(place[target], np.arange(1, int(self.length.max(initial=0)) + 2))
        for i, j in zip(edge[:-1], edge[1:]):
            if i == j:
                continue
            to = target[i:j]
            heads = np.flatnonzero(np.diff(to, prepend=-1))
            reach = total[source[i:j]] + weight[i:j]
            top = np.maximum.reduceat(reach, heads)
            spread = np.diff(np.append(heads, j - i))
            total[to[heads]] = top + np.log(np.add.reduceat(np.exp(reach - np.repeat(top, spread)), heads))
        heads = np.flatnonzero(np.diff(target, prepend=-1))
        self.begin = np.zeros(n_nodes, np.int64)
        self.begin[target[heads]] = heads
        self.cum = _cumulated(np.exp(total[source] + weight - total[target]), np.append(heads, len(target)))
        self.source, self.piece = source.astype(np.int32), piece.astype(np.int32)

    def sample(self, unit: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of one drawn path for each occurrence (unit, 64-bit key), in
        order, and how many each has."""
        first = self.first[unit]
        node = first + self.length[unit]
        who, steps = np.arange(len(unit)), []
        while True:
            alive = node[who] > first[who]
            who = who[alive]
            if not len(who):
                break
            draw = _uniform(key[who], node[who] - first[who])
            edge = self.begin[node[who]]
            wait = np.flatnonzero(self.cum[edge] < draw)
            while len(wait):
                edge[wait] += 1
                wait = wait[self.cum[edge[wait]] < draw[wait]]
            steps.append((who, self.piece[edge]))
            node[who] = self.source[edge]
        if not steps:
            return np.empty(0, np.int64), np.zeros(len(unit), np.int64)
        steps.reverse()  # drawn from the end
        whole, pieces = (np.concatenate(x) for x in zip(*steps))
        return pieces[np.argsort(whole, kind="stable")].astype(np.int64), np.bincount(whole, minlength=len(unit))


def long_path(v: Vocabulary, unit: str, key: int, block: int) -> np.ndarray:
    """What `Lattices.sample` gives for one long unit, in blocks: a block needs the
    totals of the longest piece before it. The draw at a node depends on its place
    alone, so each node draws its last edge as the filter passes. That is all that
    is kept (5 bytes a character); the path is read off from the end."""
    ch = _codes(unit)
    size_of, piece_of = np.zeros(len(ch) + 1, np.uint8), np.zeros(len(ch) + 1, np.int32)
    before = np.zeros(1)  # totals of the nodes from `low` to the block's start
    for start in range(0, len(ch), block):
        stop, low = min(len(ch), start + block), max(0, start - v.longest)
        part = ch[low:stop]
        source, size, piece, weight = _edges(v, part, np.full(len(part), len(part)))
        new = source + size > start - low
        source, size, piece, weight = source[new], size[new], piece[new], weight[new]
        order = np.argsort((source + size) * (v.longest + 1) + size)
        source, size, piece, weight = source[order], size[order], piece[order], weight[order]
        target = source + size
        heads = np.searchsorted(target, np.arange(start - low + 1, stop - low + 2))
        total = np.append(before, _totals(before, source, weight, heads, v.longest))
        cum = _cumulated(np.exp(np.minimum(total[source] + weight - total[target], 0.0)), heads)
        draw = _uniform(np.full(stop - start, key, np.uint64), np.arange(start + 1, stop + 1))
        chosen = heads[:-1].copy()
        wait = np.flatnonzero(cum[chosen] < draw)
        while len(wait):
            chosen[wait] += 1
            wait = wait[cum[chosen[wait]] < draw[wait]]
        size_of[start + 1 : stop + 1], piece_of[start + 1 : stop + 1] = size[chosen], piece[chosen]
        before = total[len(total) - min(stop, v.longest) - 1 :]
    sizes, ends, at = size_of.tolist(), [], len(ch)
    while at:
        ends.append(at)
        at -= sizes[at]
    return piece_of[ends[::-1]].astype(np.int64)


def _totals(before: np.ndarray, source: np.ndarray, weight: np.ndarray, heads: np.ndarray, reach: int) -> list[float]:
    """Log totals of the nodes behind `before`. Weights of paths are held scaled
    to a node not far back; where a sum comes near to vanishing it is taken from
    the logs, and the scale moves to its node. A weight 1e300 times that of this
    node stays there: the node's share of any sum of both is 0 either way."""
    most = math.log(1e300)
    logs, top = before.tolist(), float(before[-1])
    held = [math.exp(min(x - top, most)) for x in logs]
    first = len(logs)
    factor, source, weight, heads = np.exp(weight).tolist(), source.tolist(), weight.tolist(), heads.tolist()
    for i, j in zip(heads, heads[1:]):
        s = 0.0
        for e in range(i, j):
            s += held[source[e]] * factor[e]
        if s > 1e-100:
            logs.append(math.log(s) + top)
            held.append(s)
            continue
        terms = [logs[source[e]] + weight[e] for e in range(i, j)]
        best = max(terms)
        top = best + math.log(sum(math.exp(x - best) for x in terms))
        logs.append(top)
        held.append(1.0)
        for k in range(max(0, len(logs) - 1 - reach), len(logs) - 1):
            held[k] = math.exp(min(logs[k] - top, most))
    return logs[first:]


def _uniform(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit counters (splitmix64)."""
    with np.errstate(over="ignore"):
        z = key + _ODD * (place + 1).astype(np.uint64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _units(raw: bytes | None) -> list[str]:
    if not raw:
        return []
    text = raw.decode().replace(MARK, _OWN_MARK)
    return _UNIT.findall(MARK + text.replace(" ", MARK))


class Encoder:
    """Samples segmentations. Lattices of units that occur more than once in a
    slice are held for later ones, up to HELD_CHARS characters of units."""

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED):
        self.vocabulary, self.seed = vocabulary, seed
        self.held: list[Lattices] = []
        self.where: dict[str, tuple[int, int]] = {}
        self.chars = 0

    def _lattices(self, units: list[str], often: np.ndarray) -> tuple[list[Lattices], np.ndarray, np.ndarray]:
        """(lattices, which of them has each unit, its number there)."""
        which, number = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        again, once = [], []
        for i, u in enumerate(units):
            found = self.where.get(u)
            if found is not None:
                which[i], number[i] = found
            else:
                (again if often[i] > 1 else once).append(i)
        room = self.chars < HELD_CHARS
        lattices = list(self.held)
        for some, keep in ((again, room), (once, False)):
            if not some:
                continue
            lattices.append(Lattices(self.vocabulary, [units[i] for i in some]))
            which[some], number[some] = len(lattices) - 1, np.arange(len(some))
            if keep:
                self.held.append(lattices[-1])
                self.where.update((units[i], (len(lattices) - 1, n)) for n, i in enumerate(some))
                self.chars += sum(len(units[i]) for i in some)
        return lattices, which, number

    def encode(self, docs: list[bytes | None], keys: list[object]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offset of each text and the end);
        keys seed the draws."""
        numbers: dict[str, int] = defaultdict(itertools.count().__next__)
        unit: list[int] = []
        counts = []
        for raw in docs:
            found = _units(raw)
            counts.append(len(found))
            unit.extend(map(numbers.__getitem__, found))
        if not unit:
            return np.empty(0, np.int64), np.zeros(len(docs) + 1, np.int64)
        counts, unit = np.array(counts, np.int64), np.array(unit, np.int64)
        row_key = np.array([xxhash.xxh3_64_intdigest(f"{self.seed} {k}") for k in keys], np.uint64)
        place = np.arange(len(unit)) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            key = np.repeat(row_key, counts) ^ (place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        units = list(numbers)
        long = np.array([len(u) > LONG_UNIT for u in units])
        short = np.flatnonzero(~long)
        lattices, which, number = self._lattices([units[i] for i in short], np.bincount(unit, minlength=len(units))[short])
        of = np.full((2, len(units)), -1)
        of[:, short] = which, number
        # Pieces by lattice, then by occurrence.
        who, drawn, held = [], [], np.zeros(len(unit), np.int64)
        for n in np.unique(of[0][unit]):
            at = np.flatnonzero(of[0][unit] == n)
            if n < 0:
                got = [long_path(self.vocabulary, units[unit[i]], int(key[i]), LONG_UNIT) for i in at]
                pieces, size = np.concatenate(got), np.array([len(g) for g in got])
            else:
                pieces, size = lattices[n].sample(of[1][unit[at]], key[at])
            who.append(np.repeat(at, size))
            drawn.append(pieces)
            held[at] = size
        pieces = np.concatenate(drawn)[np.argsort(np.concatenate(who), kind="stable")]
        doc = np.repeat(np.repeat(np.arange(len(docs)), counts), held)
        pieces, doc = self._spelled(pieces, doc)
        return pieces, np.searchsorted(doc, np.arange(len(docs) + 1))

    def _spelled(self, pieces: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece (-1 - code) as their bytes' pieces."""
        odd = np.flatnonzero(pieces < 0)
        if not len(odd):
            return pieces, doc
        codes, which = np.unique(-1 - pieces[odd], return_inverse=True)
        chars = [(MARK if c == ord(_OWN_MARK) else chr(c)).encode() for c in codes.tolist()]
        n_bytes = np.array([len(c) for c in chars])[which]
        size = np.ones(len(pieces), np.int64)
        size[odd] = n_bytes
        out, at = np.repeat(pieces, size), np.cumsum(size) - size
        table = np.array([list(c.ljust(4, b"\0")) for c in chars])
        for i in range(4):
            more = n_bytes > i
            out[at[odd[more]] + i] = self.vocabulary.byte_id[table[which[more], i]]
        return out, np.repeat(doc, size)


def encode(vocabulary: Vocabulary, docs: list[bytes | None], keys: list[object], seed: int = SEED) -> list[np.ndarray]:
    """Ids of a sampled segmentation of each text; keys seed the draws."""
    ids, offsets = Encoder(vocabulary, seed).encode(docs, keys)
    return np.split(ids, offsets[1:-1]) if docs else []


def segment(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = SEED, with_ids: bool = True
) -> tuple[DataFrame, list[str]]:
    """docs with further columns, whose names are returned: `piece_ids` (unless
    with_ids is False), `n_pieces`, `ids_crc32` (of the ids as little-endian
    unsigned 32-bit integers) and `lossless`, true if decoding gives the text.

    A null or empty text has no pieces. Rows of equal key and text, null keys
    included, get equal segmentations; equal texts under different keys differ."""
    names = fresh(docs, *(["piece_ids"] if with_ids else []), "n_pieces", "ids_crc32", "lossless")
    types = [T.ArrayType(T.IntegerType())] * with_ids + [T.LongType(), T.LongType(), T.BooleanType()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        encoder = Encoder(vocabulary, seed)
        for whole in batches:
            for part in slices(whole, text):
                raw = texts(part, text)
                ids, offsets = encoder.encode(raw, part.column(key).to_pylist())
                found = np.split(ids, offsets[1:-1])
                added = [pa.ListArray.from_arrays(offsets.astype(np.int32), ids.astype(np.int32))] if with_ids else []
                added += [
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([zlib.crc32(f.astype("<u4").tobytes()) for f in found], pa.int64()),
                    pa.array([vocabulary.decode(f.tolist()) == (r or b"") for f, r in zip(found, raw)]),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, types))])
    return docs.mapInArrow(run, schema), names
