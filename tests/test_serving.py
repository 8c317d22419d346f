from conftest import rows
from pyspark.sql import functions as F

from shelfrank.operators import lookup, topk
from shelfrank.plans import serving

PROD = "productId int, name string, imageUrl string, categories string, tags string"


def test_f14_enrichment_keeps_rank_and_defaults_average(spark):
    products = spark.createDataFrame([(3, "c", "i3", "k", "t"), (9, "n", "i9", "k", "t")], PROD)
    averages = spark.createDataFrame([(3, 4.25)], "productId int, avg double")
    recs = spark.createDataFrame([(1, [(9, 0.9), (3, 0.8), (404, 0.7)])], "userId int, recs array<struct<productId:int,score:double>>")
    out = serving.user_recs(recs, products, averages, n=6)
    assert rows(out, "rank", "productId", "score") == [(1, 9, 0.0), (2, 3, 4.25)]


def test_nest_unnest_roundtrip(spark):
    long = spark.createDataFrame([(1, 2, 10, 0.5), (1, 1, 11, 0.9)], "userId int, rank int, productId int, score double")
    nested = topk.nest(long, "userId", "productId", "score", rank_col="rank")
    assert nested.first()["recs"][0]["productId"] == 11
    assert rows(topk.unnest(nested, "userId")) == rows(long.select("userId", "rank", "productId", "score"))


def test_hot_list_order(spark):
    monthly = spark.createDataFrame(
        [(1, 5, "2020-01"), (2, 9, "2019-12"), (3, 5, "2020-01"), (4, 7, "2020-01")], "productId int, count long, yearmonth string"
    )
    from shelfrank.operators import stats

    got = [r["productId"] for r in stats.hot_list(monthly, 3).orderBy("rank").collect()]
    assert got == [4, 1, 3]


def test_search_is_unanchored_and_case_sensitive(spark):
    products = spark.createDataFrame([(1, "Red bolt", "", "", ""), (2, "red bolt", "", "", "")], PROD)
    averages = spark.createDataFrame([], "productId int, avg double")
    assert rows(lookup.search_by_name(products, averages, "^red"), "productId") == [(2,)]


def test_paged_nest_roundtrip(spark):
    long = spark.createDataFrame(
        [(7, r, 100 + r, 1.0 / r) for r in range(1, 26)], "productId int, rank int, simId int, sim double"
    )
    paged = topk.nest(long, "productId", "simId", "sim", rank_col="rank", page_size=10)
    assert paged.count() == 3
    assert max(len(r["recs"]) for r in paged.collect()) == 10
    back = topk.unnest(paged, "productId")
    assert rows(back) == rows(long.select("productId", "rank", F.col("simId").alias("productId2"), "sim"))


def test_product_info_for_given_ids(spark):
    products = spark.createDataFrame([(1, "a", "", "", ""), (2, "b", "", "", ""), (3, "c", "", "", "")], PROD)
    averages = spark.createDataFrame([(2, 4.0)], "productId int, avg double")
    ids = spark.createDataFrame([(2,), (3,), (3,), (9,)], "productId int")
    assert rows(lookup.product_info(products, averages, ids), "productId", "score") == [(2, 4.0), (3, 0.0)]
