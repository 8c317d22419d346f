"""Exact all-pairs work split into bounded block-pair tasks.

Rows are hashed into B blocks of about `block_rows` rows each. Each row is
copied to the B block pairs it takes part in, and `groupBy(block pair)
.applyInPandas` hands every pair of blocks to one task, which multiplies the
two blocks with numpy and emits only what passes (pairs above a threshold, or
a per-row top-k). So:

* no cross join and no pair rows are materialised: a task holds at most two
  blocks and returns only results;
* memory per task is bounded by 2 x block_rows x dim for the vectors plus
  CHUNK_CELLS scores, whatever the data size;
* the work is spread over B(B+1)/2 (self) or Bl x Br (cross) tasks.

Ids are unique per input (one vector per item), so hash blocks are balanced;
there is no hot key to skew a block.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kernels below run in Python workers. Pickling this module by value ships
# them with each task, so executors need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A row is copied once per block it meets, so rows moved grow with the number of
# blocks; a task holds two blocks (2 x 32,768 rows of 64 doubles are 34 MB).
DEFAULT_BLOCK_ROWS = 32768
# Blocks are made smaller, down to this, while there are fewer than cores.
LEAST_BLOCK_ROWS = 2048


def _block_of(id_col: str, n_blocks: int):
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_blocks)).cast("int")


def plan_blocks(df: DataFrame, block_rows: int, min_blocks: int | None = None) -> int:
    """Number of blocks so a block holds about block_rows rows (one count job)."""
    n = df.count()
    spark = df.sparkSession
    if min_blocks is None:
        par = spark.sparkContext.defaultParallelism
        min_blocks = max(1, math.ceil(math.sqrt(2 * par)))
    return max(1, math.ceil(n / max(1, block_rows)), min(min_blocks, max(1, n)))


def replicate_self(df: DataFrame, id_col: str, n_blocks: int) -> DataFrame:
    """Copy each row to the block pairs (lo, hi) that contain its block."""
    b = _block_of(id_col, n_blocks)
    other = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    return (
        df.withColumn("_b", b)
        .withColumn("_o", other)
        .withColumn("_lo", F.least("_b", "_o"))
        .withColumn("_hi", F.greatest("_b", "_o"))
        .drop("_o")
    )


def replicate_cross(
    left: DataFrame, right: DataFrame, id_left: str, id_right: str, n_left: int, n_right: int
) -> DataFrame:
    """Copy left rows to every right block and right rows to every left block,
    keyed (_lb, _rb); `_side` is 0 for left rows, 1 for right rows. Both inputs
    must have the same columns besides their ids, which become `_id`."""
    lrep = (
        left.withColumn("_lb", _block_of(id_left, n_left))
        .withColumn("_rb", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))))
        .withColumn("_side", F.lit(0))
        .withColumnRenamed(id_left, "_id")
    )
    rrep = (
        right.withColumn("_rb", _block_of(id_right, n_right))
        .withColumn("_lb", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))))
        .withColumn("_side", F.lit(1))
        .withColumnRenamed(id_right, "_id")
    )
    return lrep.unionByName(rrep)


# ------------------------------------------------------------------ kernels


def dense_matrix(vectors: pd.Series) -> np.ndarray:
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors.values])


def row_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot product of each row of a with that of b, terms added in order, so that
    it depends on the two rows alone."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def unit_rows(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt(row_dots(m, m))[:, None]


# Scores held in a task at a time, however large the blocks are.
CHUNK_CELLS = 1 << 21


def chunk_rows(columns: int) -> int:
    """Rows of the left block that are multiplied at a time."""
    return max(1, CHUNK_CELLS // max(1, columns))


# A product of blocks may differ in its last digits with the blocks' shapes:
# pairs this near to a threshold are settled by `row_dots`.
PRODUCT_MARGIN = 1e-9


def threshold_pairs(ids_a, ua, ids_b, ub, threshold: float, same: bool, chunk: int | None = None):
    """All of `threshold_pieces` at once."""
    ids_a, ids_b = np.asarray(ids_a), np.asarray(ids_b)
    pieces = [(ids_a[:0], ids_b[:0], np.zeros(0)), *threshold_pieces(ids_a, ua, ids_b, ub, threshold, same, chunk)]
    a, b, s = (np.concatenate(c) for c in zip(*pieces))
    return a, b, s


def threshold_pieces(ids_a, ua, ids_b, ub, threshold: float, same: bool, chunk: int | None = None) -> Iterator[tuple]:
    """Pairs (a, b, cos) with cos > threshold among unit rows, both directions, a
    bounded number at a time: a block pair may hold many more than fit a task.
    The result does not depend on how rows are cut into blocks and chunks.

    same=True: a and b index the same block; only i < j is computed once and
    mirrored, and the diagonal is skipped.
    """
    ids_a, ids_b = np.asarray(ids_a), np.asarray(ids_b)
    if not len(ids_a) or not len(ids_b):
        return
    chunk = chunk or chunk_rows(len(ids_b))
    for start in range(0, len(ids_a), chunk):
        s = ua[start : start + chunk] @ ub.T
        mask = s > threshold - PRODUCT_MARGIN
        if same:
            rows = np.arange(start, start + s.shape[0])[:, None]
            mask &= np.arange(s.shape[1])[None, :] > rows
        ia, ib = np.nonzero(mask)
        ia += start
        for at in range(0, len(ia), 1 << 18):
            i, j = ia[at : at + (1 << 18)], ib[at : at + (1 << 18)]
            vals = row_dots(ua[i], ub[j])
            keep = vals > threshold
            a, b, vals = ids_a[i[keep]], ids_b[j[keep]], vals[keep]
            yield a, b, vals
            yield b, a, vals


# Scores are ranked on their value rounded to this many digits.
RANK_DIGITS = 9
# A score this near (in units of the last digit) to where rounding changes is
# kept whatever its ties, as engines may round it either way.
ROUNDING_MARGIN = 1e-3


def cut_ties(rows, order_ids, scores, k: int) -> np.ndarray:
    """Positions to keep so that each row's top k by (rounded score desc, id asc)
    stays: of equal rounded scores in a row only the k lowest ids can be in it."""
    unit = scores * 10.0**RANK_DIGITS
    key = np.round(unit)
    unsure = np.abs(np.abs(unit - np.floor(unit)) - 0.5) < ROUNDING_MARGIN
    order = np.lexsort((order_ids, key, rows))
    r, q = rows[order], key[order]
    new = np.append(True, (r[1:] != r[:-1]) | (q[1:] != q[:-1])) if len(r) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    keep = (np.arange(len(r)) - first < k) | unsure[order]
    return np.sort(order[keep])


# Columns that `matrix_top_k` takes the best of, to bound the k-th best.
GROUP = 16


def matrix_top_k(
    s: np.ndarray, col_ids, k: int, slack: float = 1e-8, positive_only: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) positions of a superset of each row's top k finite scores:
    everything within `slack` of a lower bound of the k-th best, less ties beyond
    the k lowest ids. Of wide matrices the bound is the k-th of the best scores
    of groups of columns, of which k are at least as good."""
    col_ids = np.asarray(col_ids)
    if not s.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kk = min(k, s.shape[1])
    best, groups = s, s.shape[1] // GROUP
    if groups >= 8 * kk:
        cut = groups * GROUP
        best = np.fmax.reduce(s[:, :cut].reshape(len(s), GROUP, groups), axis=1)
        best = np.concatenate([best, s[:, cut:]], axis=1)
    least = -np.partition(-best, kk - 1, axis=1)[:, kk - 1] - slack
    if positive_only:
        least = np.fmax(least, np.nextafter(0.0, 1.0))
    r, c = np.nonzero((s >= least[:, None]) & np.isfinite(s))
    if len(r) > k * s.shape[0]:
        at = cut_ties(r, col_ids[c], s[r, c], k)
        r, c = r[at], c[at]
    return r, c


def row_top_k(
    ids_rows, ids_cols, left: np.ndarray, right: np.ndarray, k: int, positive_only: bool, chunk: int | None = None
):
    """Per row of left @ right.T, a superset of its top-k columns by score (the
    exact rank, with rounding and id tie-break, is applied afterwards in
    Spark). A row emits about k columns, however many of them tie."""
    ids_rows, ids_cols = np.asarray(ids_rows), np.asarray(ids_cols)
    out_r, out_c, out_s = [ids_rows[:0]], [ids_cols[:0]], [np.zeros(0)]
    if len(ids_rows) == 0 or len(ids_cols) == 0:
        return out_r[0], out_c[0], out_s[0]
    chunk = chunk or chunk_rows(len(ids_cols))
    for start in range(0, len(ids_rows), chunk):
        s = left[start : start + chunk] @ right.T
        r, c = matrix_top_k(s, ids_cols, k, positive_only=positive_only)
        out_r.append(ids_rows[start + r])
        out_c.append(ids_cols[c])
        out_s.append(row_dots(left[start + r], right[c]))
    return np.concatenate(out_r), np.concatenate(out_c), np.concatenate(out_s)


# ------------------------------------------------------------- operators


def cross_top_k(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    vector_col: str,
    k: int,
    positive_only: bool = True,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    left_block_rows: int | None = None,
) -> DataFrame:
    """Candidates for the top-k right rows of every left row by dot product.

    Returns a superset, about k rows per left row and right block; rank it with
    `top_k_per_group` for the exact top-k. Output: (a, b, score).

    Shuffle volume is left rows x right blocks + right rows x left blocks, so
    with many more users than items give the left side large blocks
    (`left_block_rows`): the kernel multiplies in row chunks, so a large
    block costs memory for its vectors only.
    """
    lv = left.select(F.col(left_id).cast("int").alias("_l"), F.col(vector_col).alias("_v"))
    rv = right.select(F.col(right_id).cast("int").alias("_r"), F.col(vector_col).alias("_v"))
    n, cores = lv.count(), lv.sparkSession.sparkContext.defaultParallelism
    nl = max(1, math.ceil(n / (left_block_rows or block_rows)), min(cores, math.ceil(n / LEAST_BLOCK_ROWS)))
    nr = plan_blocks(rv, block_rows)
    rep = replicate_cross(lv, rv, "_l", "_r", nl, nr)

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf["_side"].values
        lp, rp = pdf[side == 0], pdf[side == 1]
        if len(lp) == 0 or len(rp) == 0:
            empty = np.zeros(0, dtype=np.int32)
            return pd.DataFrame({"a": empty, "b": empty, "score": np.zeros(0)})
        a, b, sc = row_top_k(
            lp["_id"].values, rp["_id"].values, dense_matrix(lp["_v"]), dense_matrix(rp["_v"]), k, positive_only
        )
        return pd.DataFrame({"a": a, "b": b, "score": np.asarray(sc, dtype=np.float64)})

    return rep.groupBy("_lb", "_rb").applyInPandas(kernel, schema="a int, b int, score double")
