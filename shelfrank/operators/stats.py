"""Rating statistics: all-time counts, monthly counts, average score, and the
top-n lists the server reads from them.

All aggregates are partial + final hash aggregates, so a product with a third
of all ratings is reduced map-side before the shuffle. No global sort is done
before writing; readers sort (top_n) at read time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions import year_month
from shelfrank.operators.topk import top_n
from shelfrank.sources.partitioned import PartitionedTable


def rate_more(ratings: DataFrame) -> DataFrame:
    """Ratings per product, all time: (productId, count)."""
    return ratings.groupBy("productId").agg(F.count("productId").alias("count"))


def monthly_counts(ratings: DataFrame) -> DataFrame:
    """Ratings per product per month: (productId, count, yearmonth)."""
    return (
        ratings.select("productId", year_month("timestamp").alias("yearmonth"))
        .groupBy("productId", "yearmonth")
        .agg(F.count("productId").alias("count"))
        .select("productId", "count", "yearmonth")
    )


def average_score(ratings: DataFrame) -> DataFrame:
    """Average score per product: (productId, avg)."""
    return ratings.groupBy("productId").agg(F.avg("score").alias("avg"))


def distinct_keys(ratings: DataFrame) -> DataFrame:
    """Distinct users and products: (kind, id)."""
    users = ratings.select(F.lit("user").alias("kind"), F.col("userId").alias("id")).distinct()
    prods = ratings.select(F.lit("product").alias("kind"), F.col("productId").alias("id")).distinct()
    return users.unionByName(prods)


def hot_list(monthly: DataFrame, n: int) -> DataFrame:
    """Newest months first, then most rated, then product id: top n (rank, productId, count, yearmonth)."""
    order = [F.col("yearmonth").desc(), F.col("count").desc(), F.col("productId").asc()]
    return top_n(monthly, n, order).select("rank", "productId", "count", "yearmonth")


def most_rated_list(counts: DataFrame, n: int) -> DataFrame:
    """Most rated first, then product id: top n (rank, productId, count)."""
    order = [F.col("count").desc(), F.col("productId").asc()]
    return top_n(counts, n, order).select("rank", "productId", "count")


def monthly_rollup(ratings: DataFrame) -> DataFrame:
    """One pass over the ratings: (productId, yearmonth, count, score_sum).

    The all-time count and the average per product are sums over this table,
    so the statistics job scans the rating history once instead of three times.
    """
    return (
        ratings.select("productId", year_month("timestamp").alias("yearmonth"), "score")
        .groupBy("productId", "yearmonth")
        .agg(F.count("productId").alias("count"), F.sum("score").alias("score_sum"))
    )


def rate_more_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("productId").agg(F.sum("count").alias("count"))


def average_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("productId").agg((F.sum("score_sum") / F.sum("count")).alias("avg"))


_ROLLUP = T.StructType(
    [
        T.StructField("productId", T.IntegerType()),
        T.StructField("count", T.LongType()),
        T.StructField("score_sum", T.DoubleType()),
    ]
)


class RollupTable:
    """The monthly roll-up at rest, in a folder per month, kept up to date.

    New ratings are counted on their own, and their (count, score sum) are added
    to those of the months that they fall in: these months alone are read and
    written, old ones too if a rating comes late. The history is not scanned
    again. What readers need are sums over the table."""

    def __init__(self, spark: SparkSession, path: str):
        # The month is a column of the roll-up and the folder it lies in.
        schema = T.StructType([*_ROLLUP.fields, T.StructField("month", T.StringType())])
        self.table = PartitionedTable(spark, path, schema, "yearmonth", T.StringType(), F.col("month"))

    def add(self, ratings: DataFrame, token: str) -> None:
        """Count new ratings in; those of one token are counted once."""
        new = monthly_rollup(ratings).withColumnRenamed("yearmonth", "month")
        self.table.update(new.select(*self.table.schema.fieldNames()), self._added, token)

    @staticmethod
    def _added(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.unionByName(new).groupBy("productId", "month")
        return both.agg(F.sum("count").alias("count"), F.sum("score_sum").alias("score_sum"))

    def read(self, months: list[str] | None = None) -> DataFrame:
        """(productId, yearmonth, count, score_sum), as `monthly_rollup` gives it."""
        return self.table.read(months).withColumnRenamed("month", "yearmonth")
