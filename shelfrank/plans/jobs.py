"""The batch jobs: load, statistics, offline model, item-CF and content
neighbours. Each reads and writes Parquet tables under one root folder (the
counterpart of the reference's database), overwriting its outputs.

Table names (fixed): products, ratings, rate_more_products,
rate_more_recently_products, average_products, user_recs, product_recs,
product_sims, ratings_by_product, itemcf_product_recs, content_product_recs. The streaming job keeps its
history and recs log under its own state folder
(`streaming.recommender.StreamingRecommender`).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators import als, similarity, stats, topk
from shelfrank.schemas import RANKED_SIMS
from shelfrank.sources import tables, text
from shelfrank.streaming.recommender import SIM_BUCKETS

PRODUCTS = "products"
RATINGS = "ratings"
RATE_MORE = "rate_more_products"
RATE_MORE_RECENTLY = "rate_more_recently_products"
AVERAGE = "average_products"
USER_RECS = "user_recs"
PRODUCT_RECS = "product_recs"
PRODUCT_SIMS = "product_sims"
RATINGS_BY_PRODUCT = "ratings_by_product"
ITEMCF_RECS = "itemcf_product_recs"
CONTENT_RECS = "content_product_recs"
REJECTED = "_rejected"


def _path(root: str, name: str) -> str:
    return os.path.join(root, name)


def load_job(spark: SparkSession, products_path: str, ratings_path: str, root: str) -> None:
    """Text inputs -> products and ratings tables, clustered on their lookup
    keys (productId; userId, and a second layout by productId) so row-group
    statistics serve key lookups. Malformed lines go to side tables."""
    for name, lines, parse in (
        (PRODUCTS, products_path, text.parse_product_lines),
        (RATINGS, ratings_path, text.parse_rating_lines),
    ):
        good, bad = _parsed_once(spark, spark.read.text(lines), parse, _path(root, f"_parsed/{name}"))
        bad.write.mode("overwrite").parquet(_path(root, f"{REJECTED}/{name}"))
        if name == PRODUCTS:
            tables.write_table(good, _path(root, PRODUCTS), key="productId")
        else:
            tables.write_table(good, _path(root, RATINGS), key="userId")
            tables.write_table(good, _path(root, RATINGS_BY_PRODUCT), key="productId")


def _parsed_once(spark: SparkSession, lines: DataFrame, parse, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a parser, parsed in one pass into one table that both are
    read from; clustering reads its input twice, and a text is not parsed again."""
    good, bad = parse(lines)
    both = good.select(F.struct(*good.columns).alias("good"), F.lit(None).cast("string").alias("bad")).unionByName(
        bad.select(F.lit(None).cast(good.select(F.struct(*good.columns).alias("g")).schema["g"].dataType).alias("good"), F.col("value").alias("bad"))
    )
    both.write.mode("overwrite").parquet(path)
    read = spark.read.schema(both.schema).parquet(path)
    return read.where(F.col("bad").isNull()).select("good.*"), read.where(F.col("bad").isNotNull()).select(F.col("bad").alias("value"))


def statistics_job(spark: SparkSession, root: str) -> None:
    """Rating statistics from one scan of the ratings table.

    The (product, month) roll-up is written first (it also cuts the lineage);
    the all-time counts and averages are derived from it. Monthly counts are
    partitioned by month, so the newest month is one directory for readers.
    """
    ratings = tables.read_table(spark, _path(root, RATINGS))
    rollup_path = _path(root, "_monthly_rollup")
    tables.write_table(stats.monthly_rollup(ratings), rollup_path)
    rollup = tables.read_table(spark, rollup_path)
    tables.write_table(
        rollup.select("productId", "count", "yearmonth"), _path(root, RATE_MORE_RECENTLY), partition_by="yearmonth"
    )
    tables.write_table(stats.rate_more_from_rollup(rollup), _path(root, RATE_MORE), key="productId")
    tables.write_table(stats.average_from_rollup(rollup), _path(root, AVERAGE), key="productId")


def offline_job(
    spark: SparkSession,
    root: str,
    rank: int = als.RANK,
    max_iter: int = als.MAX_ITER,
    reg_param: float = als.REG_PARAM,
    threshold: float = similarity.SIM_THRESHOLD,
    seed: int | None = 42,
    sim_buckets: int = SIM_BUCKETS,
) -> None:
    """ALS model -> per-user top-20 (user_recs) and the item similarity table
    from the item factors, all pairs above threshold: nested for serving
    (product_recs), and long and ranked in buckets of productId for the
    streaming job (product_sims), which is given the same `sim_buckets`."""
    ratings = tables.read_table(spark, _path(root, RATINGS))
    model = als.fit(ratings, rank, max_iter, reg_param, seed)
    tables.write_table(als.user_recs(model), _path(root, USER_RECS), key="userId")
    factors_path = _path(root, "_item_factors")
    tables.write_table(als.item_factors(model), factors_path)
    sims = similarity.cosine_similarity(tables.read_table(spark, factors_path), threshold)
    tables.write_buckets(similarity.rank_similar(sims), _path(root, PRODUCT_SIMS), "productId", sim_buckets)
    ranked = spark.read.schema(RANKED_SIMS).parquet(_path(root, PRODUCT_SIMS)).drop("pb")
    # Uncapped lists: nested in bounded pages (productId, first_rank, recs).
    nested = topk.nest(ranked, "productId", "simId", "sim", rank_col="rank", page_size=topk.PAGE_SIZE)
    tables.write_table(nested, _path(root, PRODUCT_RECS), key="productId")


def itemcf_job(spark: SparkSession, root: str, min_support: int = 1, k: int = similarity.MAX_RECS) -> None:
    ratings = tables.read_table(spark, _path(root, RATINGS))
    ranked = similarity.cooccurrence_similarity(ratings, min_support, k)
    nested = topk.nest(ranked, "productId", "simId", "sim", rank_col="rank")
    tables.write_table(nested, _path(root, ITEMCF_RECS), key="productId")


def content_job(spark: SparkSession, root: str, k: int = similarity.MAX_RECS) -> None:
    products = tables.read_table(spark, _path(root, PRODUCTS))
    ranked = similarity.content_similarity(products, k)
    nested = topk.nest(ranked, "productId", "simId", "sim", rank_col="rank")
    tables.write_table(nested, _path(root, CONTENT_RECS), key="productId")
