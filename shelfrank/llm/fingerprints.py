"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Every three neighbouring bytes, and every three with one byte left out, are
hashed into BUCKETS counters. A counter's quartile among all counters (two bits)
goes into the digest, before it the length on a logarithmic scale and the ratios
of the quartiles. Two digests differ by the sum of quartile distances, where
opposite quartiles weigh double, plus the distance of the lengths; their likeness
is 1 - difference / BOUND, not below 0. BOUND is the mean difference of two
independent digests; that of two short texts is smaller (`likeness`).

`with_next` pairs each document with the next one by descending doc_id without
a global sort in one task: documents go to partitions by id ranges, and the first
document of each range is also sent to the range before it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import ship
from shelfrank.llm.ranges import NULL_ID, bounds, default_parts, part_of

ship(__name__)

BUCKETS = 256
OPPOSITE = 6
LENGTH_STEP = 1.2
MAX_LENGTH_DIFF = 32
SHORT = 8
#: Mean difference of independent quartiles: 6/16 x 1 + 4/16 x 2 + 2/16 x OPPOSITE.
BOUND = BUCKETS * (6 + 4 * 2 + 2 * OPPOSITE) / 16

_MIX = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
_DISTANCE = np.abs(np.subtract.outer(np.arange(4), np.arange(4)))
_DISTANCE[_DISTANCE == 3] = OPPOSITE


def _counts(raw: bytes) -> np.ndarray:
    """Hashed triplets (i, i+1, i+2) and (i, i+1, i+3) by bucket; of a text of
    less than SHORT bytes its pairs and bytes as well, as triplets with blanks."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    out = _counts_of(b)
    if 0 < len(b) < SHORT:
        out += _counts_of(np.pad(b, (0, 1), constant_values=256)) + _counts_of(np.pad(b, (0, 2), constant_values=256))
    return out


def _counts_of(b: np.ndarray) -> np.ndarray:
    out = np.zeros(BUCKETS, np.int64)
    with np.errstate(over="ignore"):
        for salt, last in enumerate((2, 3)):
            n = len(b) - last
            if n <= 0:
                break
            h = (b[:n] + np.uint32(salt * 257)) * _MIX[0]
            h ^= b[1 : n + 1] * _MIX[1] + (h >> np.uint32(15))
            h = (h ^ (b[last : n + last] * _MIX[2])) * _MIX[0]
            out += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    return out


def fingerprint(raw: bytes) -> str:
    """Hex digest of a text's bytes: 2 digits of length, 2 of quartile ratios,
    then 2 bits for each bucket. Equal texts have equal digests; the empty text
    has length 0 and all buckets in the lowest quartile."""
    counts = _counts(raw)
    order = np.sort(counts)
    q1, q2, q3 = (int(order[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    level = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = level[0::4] << 6 | level[1::4] << 4 | level[2::4] << 2 | level[3::4]
    length = min(255, round(math.log(len(raw) + 1, LENGTH_STEP)))
    ratios = (16 * q1 // (q3 + 1)) << 4 | (16 * q2 // (q3 + 1))
    return bytes([length, ratios]).hex() + packed.astype(np.uint8).tobytes().hex()


def difference(a: str, b: str) -> int:
    """Weighted quartile distance plus the distance of lengths."""
    x, y = (np.frombuffer(bytes.fromhex(d), np.uint8) for d in (a, b))
    total = min(MAX_LENGTH_DIFF, abs(int(x[0]) - int(y[0])))
    total += min(abs(int(x[1] >> 4) - int(y[1] >> 4)), 8) + min(abs(int(x[1] & 15) - int(y[1] & 15)), 8)
    x, y = x[2:], y[2:]
    for shift in (6, 4, 2, 0):
        total += int(_DISTANCE[(x >> shift) & 3, (y >> shift) & 3].sum())
    return total


def _content(digest: str) -> int:
    """Quartile distance of a digest from one without content."""
    x = np.frombuffer(bytes.fromhex(digest), np.uint8)[2:]
    return sum(int(_DISTANCE[(x >> shift) & 3, 0].sum()) for shift in (6, 4, 2, 0))


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for a difference of BOUND or more, or of what two
    digests without a common bucket differ by, where that is less: most buckets of
    short texts are empty, and empty in both says nothing."""
    if a == b:
        return 1.0
    bound = max(1.0, min(BOUND, _content(a) + _content(b)))
    return max(0.0, 1.0 - difference(a, b) / bound)


def edited(text: str, following: str) -> str:
    """text with its last half replaced by the first code points of following."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_DEALT = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("late", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)

RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _parts(cuts: list[int]):
    edges = np.array(cuts, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = pa.array(part_of(batch.column("doc_id"), edges))
            yield pa.RecordBatch.from_arrays([part, batch.column("doc_id")], names=["part", "doc_id"])

    return run


def _deal(cuts: list[int], heads: dict[int, int]):
    """Rows with their part; rows of a part's first id again for the part before
    it (`late`: after all others there), those of the very first for the last."""
    edges = np.array(cuts, np.int64)
    parts = sorted(heads)
    before = {heads[p]: parts[(i + 1) % len(parts)] for i, p in enumerate(parts)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column("doc_id")
            zero = pa.array(np.zeros(batch.num_rows, np.int32))
            part = pa.array(part_of(doc_id, edges))
            yield pa.RecordBatch.from_arrays([part, zero, doc_id, batch.column("text")], names=_DEALT.fieldNames())
            known = doc_id.fill_null(NULL_ID).to_pylist()
            again = [i for i, d in enumerate(known) if d in before]
            if again:
                rows = batch.take(pa.array(again))
                to = pa.array([before[known[i]] for i in again], pa.int32())
                late = pa.array(np.ones(len(again), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [to, late, rows.column("doc_id"), rows.column("text")], names=_DEALT.fieldNames()
                )

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted partitions, each with the row after it."""
    held = None
    for batch in batches:
        out = []
        for part, late, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            new = (part, doc_id, text, fingerprint(text.encode()))
            if held and held[0] == part:
                _, held_id, old, digest = held
                changed = edited(old, text).encode()
                other = fingerprint(changed)
                out.append(
                    (
                        held_id,
                        len(old),
                        hashlib.sha256(changed).hexdigest(),
                        digest,
                        other,
                        likeness(digest, other),
                        likeness(digest, new[3]),
                    )
                )
            held = None if late else new
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), _ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=RESULT.fieldNames())


_ARROW = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """RESULT for every row of docs (doc_id, text): its fingerprint, that of its
    edited text, and their likeness and that to the next document's.

    Null texts count as empty. The next document follows by descending doc_id
    (nulls last), rows of equal id by ascending text; after the last comes the
    first, so a single row is its own next. An empty table gives no row."""
    parts = parts or default_parts(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = bounds(rows, parts)
    first = F.max(F.coalesce("doc_id", F.lit(NULL_ID)))
    found = rows.select("doc_id").mapInArrow(_parts(cuts), "part int, doc_id long").groupBy("part").agg(first)
    heads = dict(found.collect())
    if not heads:
        return docs.sparkSession.createDataFrame([], RESULT)
    dealt = rows.mapInArrow(_deal(cuts, heads), _DEALT).repartitionById(parts, F.col("part"))
    order = ["part", "late", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    return dealt.sortWithinPartitions(*order).mapInArrow(_compare, RESULT)
