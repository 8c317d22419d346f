"""Packing of tokenised documents into sequences by best-fit decreasing.

A document's ids, with an end id, are first cut into full windows; what is left
over is packed. Leftovers are dealt by hash into shards of about SHARD_DOCS
documents; each shard sorts its leftovers by falling length and puts each into
the open window with the least room that suffices. A segment tree indexed by
remaining room finds it: a leaf says whether a window with that room is open,
an inner node whether any leaf below it does. A shard wastes at most its own
last windows, a fixed small share, so shards pack independently at any scale.

Texts stay where they are read: only lengths and checksums are shuffled. Shards
are chosen by a hash of the row's content, and of its number among equal rows of
a task, so a repeated attempt of a task deals them out the same way.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import ship, slices, texts
from shelfrank.llm.tokens import Encoder

ship(__name__)

WINDOW = 4096
END_ID = 2
SHARD_DOCS = 8192
#: Sequence ids of a shard start at its number times this.
SHARD_STEP = 1 << 40

_CUT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("crcs", T.ArrayType(T.LongType())),
        T.StructField("shard", T.LongType()),
    ]
)

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def _cutter(tokenizer: str, window: int, end_id: int, n_shards: int):
    """Checksum of each window of each document; the last may be short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        seen: Counter = Counter()
        for whole in batches:
            for part in slices(whole, "text"):
                doc_ids = part.column("doc_id").to_pylist()
                tokens, crcs, shards = [], [], []
                for doc_id, raw in zip(doc_ids, texts(part, "text")):
                    ids = encoder.ids(raw) + end
                    tokens.append(len(ids) // 4)
                    crcs.append([zlib.crc32(ids[i : i + 4 * window]) for i in range(0, len(ids), 4 * window)])
                    row = f"{doc_id} {tokens[-1]} {crcs[-1]}"
                    shards.append(zlib.crc32(f"{row} {seen[hash(row)]}".encode()) % n_shards)
                    seen[hash(row)] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array(crcs, pa.list_(pa.int64())),
                        pa.array(shards, pa.int64()),
                    ],
                    names=_CUT.fieldNames(),
                )

    return run


class RoomTree:
    """Open windows by remaining room, with a segment tree over the room."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.some = bytearray(2 * self.base)
        self.open: dict[int, list[int]] = {}

    def put(self, room: int, window_number: int) -> None:
        stack = self.open.setdefault(room, [])
        stack.append(window_number)
        if len(stack) == 1:
            node = self.base + room
            while node and not self.some[node]:
                self.some[node] = 1
                node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, window) with the least room >= need."""
        some, node = self.some, self.base + need
        while not some[node]:
            while node & 1:  # a right child: its subtree's larger rooms lie further up
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.base:
            node = 2 * node if some[2 * node] else 2 * node + 1
        room = node - self.base
        stack = self.open[room]
        window_number = stack.pop()
        if not stack:
            some[node] = 0
            node >>= 1
            while node and not (some[2 * node] or some[2 * node + 1]):
                some[node] = 0
                node >>= 1
        return room, window_number


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Window number and offset of each item, items given by falling length,
    and the number of windows."""
    tree, numbers, offsets, n = RoomTree(window), [], [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found = window, n
            n += 1
        room, number = found
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            tree.put(room - length, number)
    return numbers, offsets, n


def _packer(window: int):
    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        doc_id, tokens, crcs = (rows.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "crcs"))
        out = []
        left = sorted(
            (i for i in range(len(tokens)) if tokens[i] % window),
            key=lambda i: (-(tokens[i] % window), doc_id[i] is None, doc_id[i] or 0, crcs[i][-1]),
        )
        numbers, offsets, n = best_fit([tokens[i] % window for i in left], window)
        base = shard * SHARD_STEP
        for i, number, offset in zip(left, numbers, offsets):
            length = tokens[i] % window
            out.append((doc_id[i], tokens[i] - length, length, crcs[i][-1], tokens[i], base + number, offset))
        for i, count in enumerate(tokens):
            for k in range(count // window):
                out.append((doc_id[i], k * window, window, crcs[i][k], count, base + n, 0))
                n += 1
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names=PIECES.fieldNames())

    return run


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """PIECES of all rows of docs (doc_id, text): each id of each document lies
    in exactly one piece, pieces of a sequence follow each other from offset 0.

    A null or empty text is its end id alone. Repeated rows are packed each for
    itself. An empty table gives no piece."""
    n_shards = max(1, math.ceil(docs.count() / shard_docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = rows.mapInArrow(_cutter(tokenizer, window, end_id, n_shards), _CUT)
    return cut.groupBy("shard").applyInArrow(_packer(window), PIECES)
