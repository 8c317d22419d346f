"""Serving queries, re-aimed from per-request lookups to batch table queries.

Each function answers one endpoint for many keys at once (all products, all
users) with joins instead of per-key lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions import java_string_hash
from shelfrank.operators import lookup, stats, topk


def hot_products(monthly: DataFrame, products: DataFrame, averages: DataFrame, n: int = 100) -> DataFrame:
    """/hot: newest month's most rated products, enriched."""
    ranked = lookup.dedupe_ranked(stats.hot_list(monthly, n))
    return lookup.enrich(ranked, products, averages, keep=["rank"])


def hot_from_table(
    spark: SparkSession, monthly_path: str, products: DataFrame, averages: DataFrame, n: int = 100
) -> DataFrame:
    """/hot read from the month-partitioned monthly-counts table.

    The hot list is the newest months first, so the top n lie in the newest
    months that together hold at least n rows: only those partitions are
    read (partition pruning), however long the history. The per-month row
    counts are one row per month.
    """
    monthly = spark.read.parquet(monthly_path)
    sizes = (
        monthly.groupBy("yearmonth").agg(F.count("*").alias("rows")).orderBy(F.col("yearmonth").desc()).collect()
    )
    keep, total = [], 0
    for row in sizes:
        keep.append(row["yearmonth"])
        total += row["rows"]
        if total >= n:
            break
    return hot_products(monthly.where(F.col("yearmonth").isin(keep)), products, averages, n)


def most_rated(counts: DataFrame, products: DataFrame, averages: DataFrame, n: int = 100) -> DataFrame:
    """/rate: most rated products of all time, enriched."""
    ranked = stats.most_rated_list(counts, n)
    return lookup.enrich(ranked, products, averages, keep=["rank"])


def _of(table: DataFrame, key: str, ids) -> DataFrame:
    """Rows of the ids given: a list becomes a filter that reaches the scan (the
    tables are clustered on their keys), a DataFrame a semi join."""
    if ids is None:
        return table
    if isinstance(ids, DataFrame):
        return table.join(ids.select(key).distinct(), key, "left_semi")
    return table.where(F.col(key).isin(list(ids)))


def user_ids(usernames: list[str] | DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """(username, userId) of the users named, by the registration's hash."""
    if not isinstance(usernames, DataFrame):
        usernames = spark.createDataFrame([(u,) for u in usernames], "username string")
    return usernames.select("username", java_string_hash("username").alias("userId"))


def neighbours(
    product_recs: DataFrame, products: DataFrame, averages: DataFrame, n: int | None = None, ids=None
) -> DataFrame:
    """/itemcf/{id} and /contentbased/{id} for every product, or for the product
    ids given (a list, or a DataFrame with productId).

    product_recs: (productId, recs). Output: (sourceId, rank, product row, score).
    """
    product_recs = _of(product_recs, "productId", ids)
    long = topk.unnest(product_recs.withColumnRenamed("productId", "sourceId"), "sourceId")
    if n is not None:
        long = long.where(F.col("rank") <= n)
    long = long.select("sourceId", "rank", "productId", F.col("score").alias("recScore"))
    return lookup.enrich(long, products, averages, keep=["sourceId", "rank", "recScore"])


def user_recs(recs: DataFrame, products: DataFrame, averages: DataFrame, n: int = 6, ids=None) -> DataFrame:
    """/offline and /stream for every user, or for the user ids given (a list,
    or a DataFrame with userId such as `user_ids` gives): the first n recs,
    enriched.

    recs: (userId, recs).
    """
    recs = _of(recs, "userId", ids)
    long = topk.unnest(recs, "userId").where(F.col("rank") <= n)
    long = long.select("userId", "rank", "productId", F.col("score").alias("recScore"))
    return lookup.enrich(long, products, averages, keep=["userId", "rank", "recScore"])
