"""Adapters: the driver's test tables -> the recommender's input schemas.

These only re-shape rows into the schemas the jobs expect (ratings, products,
rating events, latent factors, users) and render them in the text formats the
reference reads (product lines, rating CSV, event messages, log lines). They do
none of the jobs' work.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions import half_star, java_string_hash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating(userId, productId, score, timestamp) from lineitem x orders."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        (F.col("l_quantity") / F.lit(10)).cast("double").alias("score"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product(productId, name, imageUrl, categories, tags) from part."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string")).alias("imageUrl"),
        F.concat_ws("|", "p_type", "p_brand").alias("categories"),
        F.concat(F.regexp_replace("p_name", " ", "|"), F.lit("|"), F.lower("p_type")).alias("tags"),
    )


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating events (event_id, userId, productId, score, timestamp) from events.

    The raw 1..10 score is derived from `value`; stars are the server's
    half-star transform.
    """
    e = table(spark, sf_dir, "events")
    raw = F.least(F.lit(10), F.greatest(F.lit(1), F.ceil(F.col("value") / F.lit(10))))
    return e.select(
        F.col("event_id"),
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("productId"),
        half_star(raw).cast("double").alias("score"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latent factors (id, features) from embeddings."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered users from customer: userId is the Java hash of the name."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        java_string_hash("c_name").alias("userId"),
        F.col("c_name").alias("username"),
        F.lit(False).alias("first"),
        F.lit(0).cast("long").alias("timestamp"),
        F.array(F.col("c_mktsegment")).alias("prefGenres"),
    )


def registration_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usernames asking to register: every customer and supplier name."""
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("username"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("username"))
    return c.unionByName(s)


def registered_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users already registered: customers who placed an order."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return users(spark, sf_dir).join(
        table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("username")),
        "username",
    ).join(o, "c_custkey", "left_semi").drop("c_custkey")


# ---------------------------------------------------------------- text forms


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products rendered as 7-field '^' lines (value STRING); fields 2 and 3
    carry a category id list and a code that the loader drops."""
    p = table(spark, sf_dir, "part")
    prod = products(spark, sf_dir)
    joined = prod.join(p.select(F.col("p_partkey").cast("int").alias("productId"), "p_size"), "productId")
    return joined.select(
        F.concat_ws(
            "^",
            F.col("productId").cast("string"),
            F.col("name"),
            F.col("p_size").cast("string"),
            F.concat(F.lit("B"), F.lpad(F.col("productId").cast("string"), 9, "0")),
            F.col("imageUrl"),
            F.col("categories"),
            F.col("tags"),
        ).alias("value")
    )


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings rendered as comma lines 'userId,productId,score,timestamp'."""
    r = ratings(spark, sf_dir)
    return r.select(F.concat_ws(",", *[F.col(c).cast("string") for c in r.columns]).alias("value"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating events rendered as stream messages 'userId|productId|score|timestamp'."""
    e = rating_events(spark, sf_dir)
    return e.select(
        "event_id",
        F.concat_ws("|", *[F.col(c).cast("string") for c in ("userId", "productId", "score", "timestamp")]).alias(
            "value"
        ),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating events rendered as server log lines carrying the rating prefix."""
    e = rating_events(spark, sf_dir)
    stamp = F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return e.select(
        "event_id",
        F.concat(
            stamp,
            F.lit(" INFO [http-nio-8088-exec-1] RatingController - PRODUCT_RATING_PREFIX:"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in ("userId", "productId", "score", "timestamp")]),
        ).alias("value"),
    )
