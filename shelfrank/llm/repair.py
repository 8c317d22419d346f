"""Re-Pair grammar compression of an id sequence, with random access.

Each round counts all neighbouring pairs and gives the frequent ones a new
symbol (a nonterminal) each; their occurrences are replaced from the left,
without overlaps. Rounds go on until no pair is frequent or symbols run out.
A rule's parts come before it, so expansions are built front to back.

File format (little-endian), one block per shard:

    4 bytes  "RPG1"
    u32 x 6  number of documents, terminals, rules, symbols in the sequence,
             bytes per symbol (2 or 4), ids between marks
    u64      number of ids
    rules    2 x rules symbols
    lengths  rules x u32: ids that each rule expands to
    marks    (u64 first id, u32 symbol) of the first symbol that starts in or
             after every MARK_IDS ids, for random access
    docs     i64 x documents: document ids; u8 x documents: 1 where it is null
    ends     u64 x documents: ids up to the end of each document
    symbols  the compressed sequence
"""

from __future__ import annotations

import struct

import numpy as np

from shelfrank.llm.common import ship

ship(__name__)

MAGIC = b"RPG1"
MARK_IDS = 4096
#: A pair needs this many occurrences to get a rule.
MIN_PAIR = 8
MAX_RULES = 16_000
MAX_ROUNDS = 16
#: Rounds end when one shortens the sequence by less than this share.
LEAST_SAVED = 0.01
RULES_PER_ROUND = 4_000
_BIN_BITS = 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _frequent(code: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the most frequent pairs, the positions where they occur, and
    which of them occurs there. Hashed bins leave out the positions of pairs that
    cannot be frequent before the exact count, and find the pairs again; of pairs
    in one bin the most frequent is taken now, the others in a later round."""
    bits = 32 if code.dtype == np.uint32 else 64
    h = ((code * code.dtype.type(int(_ODD) >> (64 - bits) | 1)) >> code.dtype.type(bits - _BIN_BITS)).astype(np.int32)
    maybe = np.bincount(h, minlength=1 << _BIN_BITS) >= least
    at = np.flatnonzero(maybe[h])
    code, h = code[at], h[at]
    ordered = np.sort(code)
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, np.int64)
    times = np.diff(np.append(first, len(ordered)))
    good = times >= least
    value, times = ordered[first[good]], times[good]
    best = np.sort(np.argsort(-times, kind="stable")[:most])
    value, times = value[best], times[best]
    bin_of = np.full(1 << _BIN_BITS, -1, np.int32)
    by_times = np.argsort(times, kind="stable")
    v = value[by_times]
    bin_of[((v * v.dtype.type(int(_ODD) >> (64 - bits) | 1)) >> v.dtype.type(bits - _BIN_BITS)).astype(np.int32)] = by_times
    which = bin_of[h]
    hit = np.flatnonzero(which >= 0)
    hit = hit[value[which[hit]] == code[hit]]
    return value, at[hit], which[hit]


def _without_overlaps(at: np.ndarray) -> np.ndarray:
    """Of runs of neighbouring positions, mark every second, from the first on."""
    new = np.append(True, np.diff(at) != 1)
    run = np.maximum.accumulate(np.where(new, at, 0))
    return (at - run) % 2 == 0


def compress(ids: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): rule r, a pair of symbols, is symbol terminals + r."""
    # A pair is one number: 32 bits where symbols have 16.
    small = terminals + MAX_RULES <= 1 << 16
    kind, shift = (np.uint32, np.uint32(16)) if small else (np.uint64, np.uint64(32))
    seq = ids.astype(kind)
    rules = np.empty((0, 2), np.int64)
    for _ in range(MAX_ROUNDS):
        room = min(RULES_PER_ROUND, MAX_RULES - len(rules))
        if len(seq) < 2 or room <= 0:
            break
        pairs, at, which = _frequent((seq[:-1] << shift) | seq[1:], MIN_PAIR, room)
        if not len(at):
            break
        free = _without_overlaps(at)
        at, which = at[free], which[free]
        used = np.bincount(which, minlength=len(pairs)) > 0
        symbol = np.cumsum(used) - 1 + terminals + len(rules)
        seq[at] = symbol[which]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, pairs = seq[keep], pairs[used]
        rules = np.vstack([rules, np.stack([pairs >> shift, pairs & kind((1 << int(shift)) - 1)], 1).astype(np.int64)])
        if len(at) < LEAST_SAVED * len(seq):
            break
    return seq.astype(np.int64), rules


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that each symbol expands to, terminals included."""
    out = np.ones(terminals + len(rules), np.int64)
    for r, (a, b) in enumerate(rules.tolist()):
        out[terminals + r] = out[a] + out[b]
    return out


def encode_shard(doc_ids: list[int | None], docs: list[np.ndarray], terminals: int) -> bytes:
    """The block of a shard: its documents' ids, in this order."""
    ids = np.concatenate(docs) if docs else np.empty(0, np.uint32)
    symbols, rules = compress(ids, terminals)
    length = expansion_lengths(rules, terminals)
    starts = np.cumsum(length[symbols]) - length[symbols]
    marked = np.searchsorted(starts, np.arange(0, len(ids), MARK_IDS))
    marked = np.minimum(marked, max(0, len(symbols) - 1))
    width = 2 if terminals + len(rules) <= 1 << 16 else 4
    kind = f"<u{width}"
    marks = np.zeros(len(marked), [("id", "<u8"), ("symbol", "<u4")])
    marks["id"], marks["symbol"] = starts[marked], marked
    return b"".join(
        [
            MAGIC,
            struct.pack("<6IQ", len(docs), terminals, len(rules), len(symbols), width, MARK_IDS, len(ids)),
            rules.astype(kind).tobytes(),
            length[terminals:].astype("<u4").tobytes(),
            marks.tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.cumsum([len(d) for d in docs], dtype="<u8").tobytes(),
            symbols.astype(kind).tobytes(),
        ]
    )


class Shard:
    """A block opened for reading."""

    def __init__(self, block: bytes):
        if block[:4] != MAGIC:
            raise ValueError("not a Re-Pair block")
        n_docs, self.terminals, n_rules, n_symbols, width, self.mark_ids, self.n_ids = struct.unpack_from("<6IQ", block, 4)
        self._block, self._at, kind = block, 36, f"<u{width}"
        self.rules = self._take(kind, 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.lengths = np.append(np.ones(self.terminals, np.int64), self._take("<u4", n_rules).astype(np.int64))
        self.marks = self._take([("id", "<u8"), ("symbol", "<u4")], -(-self.n_ids // self.mark_ids))
        ids, null = self._take("<i8", n_docs).tolist(), self._take(np.uint8, n_docs).tolist()
        self.doc_ids = [None if n else d for d, n in zip(ids, null)]
        self.ends = self._take("<u8", n_docs).astype(np.int64)
        self.symbols = self._take(kind, n_symbols).astype(np.int64)
        self._expand_rules()

    def _take(self, kind, count: int) -> np.ndarray:
        out = np.frombuffer(self._block, kind, count, self._at)
        self._at += out.nbytes
        return out

    def _expand_rules(self) -> None:
        """All symbols' expansions in one array, shorter ones first."""
        length = self.lengths
        self.begin = np.cumsum(length) - length
        self.flat = np.zeros(int(length.sum()), np.uint32)
        self.flat[: self.terminals] = np.arange(self.terminals)
        begin = self.begin.tolist()
        size = length.tolist()
        for r, (a, b) in enumerate(self.rules.tolist(), self.terminals):
            at = begin[r]
            self.flat[at : at + size[a]] = self.flat[begin[a] : begin[a] + size[a]]
            self.flat[at + size[a] : at + size[r]] = self.flat[begin[b] : begin[b] + size[b]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of consecutive symbols."""
        length = self.lengths[symbols]
        ends = np.cumsum(length)
        shift = np.repeat(self.begin[symbols] - (ends - length), length)
        return self.flat[shift + np.arange(len(shift))]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the shard, from the nearest mark on."""
        if start >= stop:
            return np.empty(0, np.uint32)
        mark = self.marks[min(start // self.mark_ids, len(self.marks) - 1)]
        if int(mark["id"]) > start:
            mark = self.marks[start // self.mark_ids - 1]
        first, found, got = int(mark["symbol"]), [], 0
        need = stop - int(mark["id"])
        while got < need:
            part = self.symbols[first : first + 2048]
            found.append(self.expand(part))
            got += len(found[-1])
            first += 2048
        return np.concatenate(found)[start - int(mark["id"]) : need]

    def documents(self) -> list[tuple[int | None, int, np.ndarray]]:
        """(document id, ids before it, its ids) of all documents."""
        ids = self.expand(self.symbols)
        starts = np.append(0, self.ends[:-1]) if len(self.ends) else self.ends
        return [(d, a, ids[a:b]) for d, a, b in zip(self.doc_ids, starts.tolist(), self.ends.tolist())]
