"""Product lookups: enrichment of ranked id lists with product rows and their
average score, key/regex lookups.

Enrichment is one join (the server issues one average lookup per product).
The join strategy is left to Catalyst/AQE: a ranked list of bounded length is
small and gets broadcast from measured sizes; a large list (all users' recs)
joins by sort-merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRODUCT_COLS = ["productId", "name", "imageUrl", "categories", "tags"]


def with_average(products: DataFrame, averages: DataFrame) -> DataFrame:
    """Products with `score` = average rating, 0.0 when never rated."""
    avg = averages.select("productId", F.col("avg"))
    return (
        products.select(*PRODUCT_COLS)
        .join(avg, "productId", "left")
        .select(*PRODUCT_COLS, F.coalesce(F.col("avg"), F.lit(0.0)).alias("score"))
    )


def enrich(ranked: DataFrame, products: DataFrame, averages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Ranked ids (productId + `keep` columns) -> product rows with average score.

    Ids without a product row drop out (inner join); the rank columns in
    `keep` carry the list order the IN lookup of the server loses.
    """
    keep = keep or []
    served = with_average(products, averages)
    return ranked.select("productId", *keep).join(served, "productId").select(*keep, *PRODUCT_COLS, "score")


def product_info(products: DataFrame, averages: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Product rows with average score, for all products or the ids given."""
    served = with_average(products, averages)
    if ids is not None:
        served = served.join(ids.select("productId").distinct(), "productId", "left_semi")
    return served


def search_by_name(products: DataFrame, averages: DataFrame, pattern: str) -> DataFrame:
    """Unanchored, case-sensitive regex search on the product name."""
    return with_average(products.where(F.col("name").rlike(pattern)), averages)


def dedupe_ranked(ranked: DataFrame, key: str = "productId", rank_col: str = "rank") -> DataFrame:
    """One row per id, at its best rank (an IN lookup returns each product once)."""
    return ranked.groupBy(key).agg(F.min(rank_col).alias(rank_col))
