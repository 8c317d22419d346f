"""Lists of (id, code) as a few bytes an entry, and the best rows of scored lists.

A list's ids rise, so their differences are small numbers; differences and codes
are written as bytes of 7 bits, the last of a number below 128. All is done for
many lists at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from shelfrank.operators.blocked import RANK_DIGITS, ROUNDING_MARGIN

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of lists that are read at a time.
SLICE = 1 << 20
#: Lists ranked at a time, and bits of the codes sorted with them.
ROWS = 1 << 11
CODE_BITS = 20


def encode(ids: np.ndarray, codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each list) of lists of the given sizes, side by side: ids of
    32 bits, rising within a list, and codes from 0."""
    ids = ids.astype(np.int64)
    step = np.diff(ids, prepend=0)
    first = (np.cumsum(size) - size)[size > 0]
    step[first] = (ids[first] << 1) ^ (ids[first] >> 63)  # a list's first id may be negative
    values = np.empty(2 * len(ids), np.int64)
    values[0::2], values[1::2] = step, codes
    width = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        more = values >> bits > 0
        if not more.any():
            break
        width += more
    ends = np.cumsum(width)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for j in range(int(width.max()) if len(width) else 0):
        has = width > j
        out[(ends - width)[has] + j] = (values[has] >> (7 * j)) & 127 | np.where(width[has] - 1 > j, 128, 0)
    return out, np.append(0, ends)[2 * np.cumsum(size)]


def decode(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, codes, number of the list) of lists side by side, which end at `ends`."""
    stop = np.flatnonzero(data < 128)
    begin = np.append(0, stop[:-1] + 1) if len(stop) else stop
    values = (data[begin] & 127).astype(np.int64)
    longer = np.flatnonzero(stop > begin)
    j = 1
    while len(longer):
        values[longer] |= (data[begin[longer] + j] & 127).astype(np.int64) << (7 * j)
        j += 1
        longer = longer[stop[longer] >= begin[longer] + j]
    ids, codes = values[0::2].copy(), values[1::2]
    upto = np.searchsorted(stop, ends) // 2
    size = np.diff(upto, prepend=0)
    first = (upto - size)[size > 0]
    ids[first] = (ids[first] >> 1) ^ -(ids[first] & 1)
    total = np.cumsum(ids)
    base = np.zeros(len(size), np.int64)
    base[size > 0] = total[first] - ids[first]
    row = np.repeat(np.arange(len(size)), size)
    return total - base[row], codes, row


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of some lists, side by side."""
    before = np.cumsum(size, dtype=np.int64) - size
    return data[np.repeat(start - before, size) + np.arange(int(size.sum()))]


def slices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, ends) of a column of lists, about SLICE bytes at a time."""
    buffers = column.buffers()
    ends = np.frombuffer(buffers[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, "right")) - 1)
        yield data[ends[at] : ends[upto]].copy(), ends[at + 1 : upto + 1] - ends[at]
        at = upto


def best_rows(row: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each list's k first entries by score (from 0 to 1, rounded to
    RANK_DIGITS) from the best on, then by position; where engines may round the
    scores either way, of all that can be among them. row: numbers of the lists, rising."""
    # (row, score from the best on, position) as one number: these sort fast.
    unit = score * 10.0**RANK_DIGITS
    key = np.rint(unit).astype(np.int64)
    bits = max(1, int(len(row) - 1).bit_length())
    if (int(row[-1]) + 1).bit_length() + 30 + bits > 63 or key.max() >= 1 << 30:
        order = np.lexsort((np.arange(len(row)), -key, row))
    else:
        order = np.sort((((row << 30) | ((1 << 30) - 1 - key)) << bits) | np.arange(len(row))) & ((1 << bits) - 1)
    row, key, unit = row[order], key[order], unit[order]
    where = np.arange(len(row))
    start = np.append(True, row[1:] != row[:-1])
    first = np.flatnonzero(start)
    number = np.cumsum(start) - 1
    place = where - first[number]
    last = np.minimum(first + k, np.append(first[1:], len(row))) - 1
    near = key >= key[last][number] - 2
    unsure = near & (np.abs(np.abs(unit - np.floor(unit)) - 0.5) < ROUNDING_MARGIN)
    risky = np.zeros(len(first), bool)
    risky[number[unsure]] = True
    tie = np.maximum.accumulate(np.where(start | np.append(True, key[1:] != key[:-1]), where, 0))
    keep = (place < k) | (near & risky[number] & ((where - tie < k) | unsure))
    return order[keep]
