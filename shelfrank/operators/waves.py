"""Exact top-k by dot product, items met in order of their norms.

No item scores more than |user| x |item| (Cauchy-Schwarz). Items are met in
waves of falling norm, each wave twice as large as the one before. After a wave
a user whose k-th score is above |user| x (largest norm still to come) has their
list, and meets no further item. Users who go on carry their k best along.

A wave multiplies blocks of open users with blocks of its items
(`blocked.cross_top_k`), so rows copied shrink with the open users. There are at
most log2(items / block) waves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import RANK_DIGITS, l2norm
from shelfrank.operators import blocked
from shelfrank.operators.topk import top_k_per_group
from shelfrank.session import ensure_checkpoint_dir

#: Scores that round to the same rank key may lie this far apart.
SLACK = 2 * 10.0**-RANK_DIGITS


@dataclass
class Wave:
    """What one wave did: items met, users that met them, rows copied for it."""

    items: int
    users: int
    copies: int


def _cuts(items: DataFrame, n: int, first: int) -> list[float]:
    """Norms, falling, that cut n items into waves of first, 2 first, ... items."""
    shares, done, size = [], 0, first
    while done + size < n:
        done += size
        shares.append(1 - done / n)
        size *= 2
    if not shares:
        return []
    found = items.agg(F.percentile_approx("norm", shares, 10_000)).first()[0]
    return sorted(set(found), reverse=True)


def top_k_by_norm(
    users: DataFrame,
    items: DataFrame,
    k: int,
    positive_only: bool = True,
    block_rows: int = blocked.DEFAULT_BLOCK_ROWS,
    user_block_rows: int | None = None,
) -> tuple[DataFrame, list[Wave]]:
    """((userId, rank, productId, score), waves): the k best items of each user by
    score, ties by productId. users and items: (id, features)."""
    ensure_checkpoint_dir(users.sparkSession)
    normed = items.select("id", "features", l2norm("features").alias("norm"))
    n_items = normed.count()
    cuts = _cuts(normed, n_items, block_rows)
    bounds = [math.inf, *cuts, -math.inf]
    open_ = users.select("id", "features")
    if cuts:
        normed = normed.checkpoint()
        open_ = open_.withColumn("norm", l2norm("features")).checkpoint()
    done, carried, report = [], None, []
    for high, low in zip(bounds, bounds[1:]):
        part = normed.where((F.col("norm") < high) & (F.col("norm") >= low))
        found = blocked.cross_top_k(open_, part, "id", "id", "features", k, positive_only, block_rows, user_block_rows)
        found = found.select(F.col("a").alias("userId"), F.col("b").alias("productId"), "score")
        if carried is not None:
            found = found.unionByName(carried)
        best = top_k_per_group(found, "userId", k, score="score", tie_breakers=["productId"])
        if cuts:
            here, met = part.count(), open_.count()
            left = math.ceil(met / (user_block_rows or block_rows))
            report.append(Wave(here, met, met * math.ceil(here / block_rows) + here * left))
        if low == -math.inf:
            done.append(best)
            break
        best = best.checkpoint()
        kth = best.where(F.col("rank") == k).select(F.col("userId").alias("id"), F.col("score").alias("kth"))
        most = F.col("norm") * low
        over = F.coalesce(F.col("kth") > most * (1 + 1e-12) + SLACK, F.lit(False))
        if positive_only:
            over |= most <= 0
        open_ = open_.join(kth, "id", "left").where(~over).drop("kth").checkpoint()
        rest = open_.select(F.col("id").alias("userId"))
        done.append(best.join(rest, "userId", "left_anti"))
        if open_.isEmpty():
            break
        carried = best.join(rest, "userId", "left_semi").select("userId", "productId", "score")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("userId", "rank", "productId", "score"), report
