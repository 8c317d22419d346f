"""A user with a third of all ratings: results stay exact with AQE's skew
handling forced on (thresholds lowered so hot partitions really get split)."""

import math
from collections import Counter, defaultdict

import pytest
from conftest import rows

from shelfrank.operators import cooccur, similarity, state
from shelfrank.session import scratch_path

EV = "event_id long, userId int, productId int, score double, timestamp long"


@pytest.fixture()
def skew_conf(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_events(spark):
    data, eid = [], 0
    for p in range(300):  # hot user 0 rates 300 products
        data.append((eid, 0, p, float(1 + p % 5), 1000 + eid))
        eid += 1
    for u in range(1, 120):  # 119 light users, 5 ratings each
        for j in range(5):
            data.append((eid, u, (u * 7 + j * 13) % 300, float(1 + (u + j) % 5), 1000 + eid))
            eid += 1
    return spark.createDataFrame(data, EV), data


@pytest.mark.parametrize("support,heavy_items", [(1, 100_000), (1, 100), (1, 4), (2, 100), (4, 3)])
def test_itemcf_hot_user_exact(spark, skew_conf, support, heavy_items):
    # heavy_items=100_000: the hot user goes through the skew-split self-join;
    # 100: its pairs are counted by product blocks; 4 and 3: all users' are.
    df, data = skewed_events(spark)
    out = similarity.cooccurrence_similarity(df, min_support=support, k=None, heavy_items=heavy_items)
    got = {(r["productId"], r["simId"]): r["sim"] for r in out.collect()}
    users = defaultdict(set)
    for _, u, p, _, _ in data:
        users[u].add(p)
    n = Counter(p for s in users.values() for p in s)
    pairs = Counter((a, b) for s in users.values() for a in s for b in s if a != b)
    exp = {k: c / math.sqrt(n[k[0]] * n[k[1]]) for k, c in pairs.items() if c >= support}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_recent_and_upsert_hot_user(spark, skew_conf):
    df, data = skewed_events(spark)
    recent = state.recent_n(df, 40)
    hot = [r["productId"] for r in recent.where("userId = 0").orderBy("rank").collect()]
    assert hot == list(range(299, 259, -1))
    up = state.upsert_ratings(df.limit(0).drop("event_id"), df)
    assert up.count() == len({(u, p) for _, u, p, _, _ in data})
    assert rows(up.where("userId = 0"), "productId") == [(p,) for p in range(300)]


def test_rank_all_splits_hot_group_exactly(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from shelfrank.operators.topk import rank_all

    data = [(1, j, float(j % 17)) for j in range(900)] + [(g, j, float(j)) for g in range(2, 40) for j in range(5)]
    df = spark.createDataFrame(data, "productId int, simId int, sim double")
    order = [F.col("sim").desc(), F.col("simId").asc()]
    got = rank_all(df, "productId", order, partitions=7)
    w = Window.partitionBy("productId").orderBy(*order)
    exp = df.withColumn("rank", F.row_number().over(w))
    assert rows(got.select("productId", "simId", "sim", "rank")) == rows(exp)


def test_rank_all_with_adaptive_partitions(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from shelfrank.operators.topk import rank_all

    data = [(1, j, float(j % 23)) for j in range(2000)] + [(g, j, float(j % 3)) for g in range(2, 300) for j in range(4)]
    df = spark.createDataFrame(data, "productId int, simId int, sim double")
    order = [F.col("sim").desc(), F.col("simId").asc()]
    got = rank_all(df, "productId", order)
    exp = df.withColumn("rank", F.row_number().over(Window.partitionBy("productId").orderBy(*order)))
    assert rows(got.select("productId", "simId", "sim", "rank")) == rows(exp)


def test_heavy_pairs_by_chunk_and_block(spark, skew_conf):
    """A product that every user has, users and products cut into many parts."""
    data = [(u, 0) for u in range(90)] + [(u, p) for u in range(90) for p in range(1, 60) if (u * p) % 7 < 3]
    df = spark.createDataFrame(data, "userId int, productId int")
    users = defaultdict(set)
    for u, p in data:
        users[u].add(p)
    want = Counter((a, b) for s in users.values() for a in s for b in s if a < b)
    for chunk, block in ((1000, 1000), (11, 13), (4, 60)):
        got = cooccur.heavy_pairs(df, chunk, block).collect()
        assert {(r.a, r.b): r.n for r in got} == want and len(got) == len(want)


def test_upkeep_equals_full_count(spark):
    """Batches with new users, new products of known users, repeated and known
    ratings, each added twice; a hot user is in every batch."""
    df, data = skewed_events(spark)
    table = cooccur.CooccurrenceTable(spark, scratch_path(spark, "itemcf"), 4)
    cut = lambda i: spark.createDataFrame([d for j, d in enumerate(data) if j % 4 == i or (i and j % 13 == i)], EV)
    table.load(cut(0))
    for i in (1, 2, 3):
        table.add(cut(i), f"add-{i}")
        table.add(cut(i), f"add-{i}")
    up = df.select("userId", "productId").distinct()
    assert rows(table.pairs.read()) == rows(cooccur.pair_counts(up))
    assert rows(table.items.read()) == rows(up)
    assert rows(table.similarity(2)) == rows(similarity.cooccurrence_similarity(df, 2, None).drop("rank"))


def test_upkeep_that_broke_off_is_repeated(spark, monkeypatch):
    _, data = skewed_events(spark)
    first, more = spark.createDataFrame(data[:400], EV), spark.createDataFrame(data[400:], EV)
    table = cooccur.CooccurrenceTable(spark, scratch_path(spark, "itemcf"), 4)
    table.load(first)

    def lost(*_):
        raise RuntimeError("lost")

    for broken in (table.pairs, table.counts, table.items):
        with monkeypatch.context() as m:
            m.setattr(broken, "update", lost)
            with pytest.raises(RuntimeError):
                table.add(more, "more")
    table.add(more, "more")
    up = first.unionByName(more).select("userId", "productId").distinct()
    assert rows(table.pairs.read()) == rows(cooccur.pair_counts(up))


def test_upkeep_rewrites_touched_buckets(spark):
    df, _ = skewed_events(spark)
    table = cooccur.CooccurrenceTable(spark, scratch_path(spark, "itemcf"), 16)
    table.load(df)
    files = lambda t: set(spark.read.parquet(t.path).inputFiles())
    before = files(table.pairs), files(table.items)
    table.add(spark.createDataFrame([(1, 9001, 7001, 1.0, 1), (2, 9001, 7002, 1.0, 1)], EV), "new")
    assert len(before[0] - files(table.pairs)) <= 1 and len(before[1] - files(table.items)) <= 1
    assert rows(table.pairs.read().where("a >= 7000")) == [(7001, 7002, 1)]
