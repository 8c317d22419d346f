from collections import defaultdict

import numpy as np
from conftest import SF_SMALL
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators import als, similarity, sweep
from shelfrank.plans import catalog
from shelfrank.sources import adapters


def test_user_recs_invariants(spark):
    model = als.fit(adapters.ratings(spark, SF_SMALL), rank=5, max_iter=5, reg_param=0.1)
    long = als.user_recs_long(model, 20).collect()
    per_user = defaultdict(list)
    for r in long:
        per_user[r["userId"]].append((r["rank"], r["productId"], r["score"]))
    assert per_user
    for recs in per_user.values():
        recs.sort()
        assert len(recs) <= 20
        scores = [s for _, _, s in recs]
        assert all(s > 0 for s in scores)
        assert scores == sorted(scores, reverse=True)
        assert len({p for _, p, _ in recs}) == len(recs)


def test_hash_split_and_rmse(spark):
    lab = als.hash_split(adapters.ratings(spark, SF_SMALL))
    counts = {r["split"]: r["count"] for r in lab.groupBy("split").count().collect()}
    frac = counts["train"] / (counts["train"] + counts["test"])
    assert 0.6 < frac < 0.8
    train = lab.where("split = 'train'")
    test = lab.where("split = 'test'")
    model = als.fit(train, rank=4, max_iter=5, reg_param=0.1)
    res = als.rmse(test, als.predict(model, test)).first()
    assert res["n"] > 0 and res["rmse"] >= 0


def test_grid_marks_one_best(spark):
    lab = als.hash_split(adapters.ratings(spark, SF_SMALL))
    grid = als.grid_search(lab.where("split = 'train'"), lab.where("split = 'test'"), (2, 3), (0.1,), max_iter=3)
    out = grid.collect()
    assert len(out) == 2 and sum(r["best"] for r in out) == 1
    best = [r for r in out if r["best"]][0]
    assert best["rmse"] == min(r["rmse"] for r in out)


def test_grid_is_the_same_in_parallel(spark):
    lab = als.hash_split(adapters.ratings(spark, SF_SMALL))
    sides = lab.where("split = 'train'"), lab.where("split = 'test'")
    one, four = (als.grid_search(*sides, (2, 3), (0.1, 1.0), max_iter=2, parallelism=n).collect() for n in (1, 4))
    assert [(r.rank, r.regParam, r.best) for r in one] == [(r.rank, r.regParam, r.best) for r in four]
    assert all(abs(a.rmse - b.rmse) < 1e-6 for a, b in zip(one, four))


def test_user_recs_equal_sparks_lists(spark):
    model = als.fit(adapters.ratings(spark, SF_SMALL), rank=4, max_iter=3, reg_param=0.1)
    theirs = {r["userId"]: [(x["productId"], x["rating"]) for x in r["recommendations"]] for r in model.recommendForAllUsers(7).collect()}
    theirs = {u: [x for x in recs if x[1] > 0] for u, recs in theirs.items()}
    ours = {r["userId"]: [(x["productId"], x["score"]) for x in r["recs"]] for r in als.user_recs(model, 7).collect()}
    assert set(ours) == {u for u, recs in theirs.items() if recs}
    for user, recs in ours.items():
        assert [p for p, _ in recs] == [p for p, _ in theirs[user]]
        assert all(abs(a - b) < 1e-5 for (_, a), (_, b) in zip(recs, theirs[user]))
    # Floats added in order, so that scores are the model's to the last digit.
    s = sweep._float_dots(np.array([[1e8, 1, -1e8]], np.float32), np.ones((1, 3), np.float32))
    assert s[0] == 0


def test_user_recs_form_no_product_of_tables(spark):
    model = als.fit(adapters.ratings(spark, SF_SMALL), rank=2, max_iter=1, reg_param=0.1)
    assert "Cartesian" not in als.user_recs(model, 5)._jdf.queryExecution().toString()


def test_sweep_equals_brute_force_over_blocks(spark):
    rng = np.random.default_rng(3)
    users, items = (np.round(rng.normal(size=(n, 3)) * 8).astype(np.float32) / 8 for n in (300, 900))  # exact products
    items[400:800] = items[:400]  # copies tie; the larger id goes first
    users[7], items[9] = 0, 0
    frame = lambda m: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id int, features array<float>")
    for item_rows, user_rows in ((None, None), (100, 70)):
        got = {r["userId"]: [(x["productId"], x["score"]) for x in r["recs"]] for r in sweep.top_k(frame(users), frame(items), 11, item_rows, user_rows).collect()}
        s = users @ items.T
        for u in range(len(users)):
            order = np.lexsort((-np.arange(len(items)), -s[u]))[:11]
            want = [(int(i), float(s[u, i])) for i in order if s[u, i] > 0]
            assert [i for i, _ in got.get(u, [])] == [i for i, _ in want]
            assert np.allclose([x for _, x in got.get(u, [])], [x for _, x in want], atol=1e-5)
        assert 7 not in got


def test_best_items_beyond_the_first_stretch(monkeypatch):
    monkeypatch.setattr(sweep, "STRETCH", 16)
    monkeypatch.setattr(sweep, "USERS", 8)
    rng = np.random.default_rng(5)
    users, items = (rng.normal(size=(n, 4)).astype(np.float32) for n in (50, 200))
    row, found, _ = sweep.best_items(users, np.arange(200, dtype=np.int32), items, 20)
    s = users.astype(float) @ items.astype(float).T
    for u in range(50):
        assert list(found[row == u]) == [i for i in np.argsort(-s[u])[:20] if s[u, i] > 0]


def test_similarity_check_moves_no_pairs(spark, monkeypatch):
    """Pairs were checkpointed and dealt by key several times."""
    written = []
    checkpoint = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a: (written.append(self.columns), checkpoint(self, *a))[1])
    out = catalog.q_als_item_similarity_check(spark, SF_SMALL)
    assert out.first().asDict() == {"asymmetric": 0, "below": 0, "differs": 0, "lost": 0}
    assert not any("simId" in columns for columns in written)


def test_similarity_check_counts_faults(spark, monkeypatch):
    whole = similarity.cosine_similarity

    def faulty(factors):
        sims = whole(factors).where("NOT (productId = 100 AND simId < 120)")  # lost, and their mirror images alone
        off = F.when(F.col("productId") == 7, F.col("sim") - 0.7).when(F.col("simId") == 7, F.col("sim") - 0.7).otherwise(F.col("sim"))
        return sims.select("productId", "simId", off.alias("sim"))

    model = als.fit(adapters.ratings(spark, SF_SMALL), catalog.ALS_RANK, catalog.ALS_ITER, catalog.ALS_REG)
    # One fit for both: a fit of its own may differ in the last digits.
    monkeypatch.setattr(als, "fit", lambda *a: model)
    pairs = whole(als.item_factors(model)).select("productId", "simId").collect()
    gone = sum(a == 100 and b < 120 for a, b in pairs)
    seven = sum(7 in (a, b) and not (a == 100 and b < 120) for a, b in pairs)
    assert gone and seven
    monkeypatch.setattr(similarity, "cosine_similarity", faulty)
    out = catalog.q_als_item_similarity_check(spark, SF_SMALL).first()
    assert out["lost"] == gone and out["asymmetric"] == gone
    assert out["differs"] == seven and out["below"] == seven


def test_unmirrored_equals_plain_join(spark):
    rows = [(1, 2, 0.7), (2, 1, 0.7), (1, 3, 0.8), (3, 4, 0.9), (4, 3, 0.9 + 1e-12), (5, 6, 0.9), (6, 5, 0.91)]
    rows += [(7, 8, 0.7), (7, 8, 0.7), (8, 7, 0.7), (9, 10, 0.7), (9, 10, 0.7)]
    sims = spark.createDataFrame(rows, "productId int, simId int, sim double")
    groups = sims.select(*similarity.mirror_sums()).groupBy("group").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    assert similarity.unmirrored(sims, groups).first()["asymmetric"] == 5
    assert groups.where("up = 0 AND down = 0").count() >= 1


def test_fit_leaves_few_shuffles_and_equals_sparks_own(spark):
    """Checkpoints let Spark drop the factors shuffled before them, and change none."""
    from pyspark.ml.recommendation import ALS

    ratings = adapters.ratings(spark, SF_SMALL).select("userId", "productId", F.col("score").cast("float").alias("score"))
    plain = ALS(rank=3, maxIter=6, regParam=0.1, userCol="userId", itemCol="productId", ratingCol="score", coldStartStrategy="drop", seed=42).fit(ratings)
    model = als.fit(ratings, rank=3, max_iter=6, reg_param=0.1)
    known = lambda m: {r["id"]: list(r["features"]) for r in m.itemFactors.collect()}
    ours, theirs = known(model), known(plain)
    assert ours.keys() == theirs.keys()
    assert all(abs(x - y) < 1e-4 for i in ours for x, y in zip(ours[i], theirs[i]))


def _params(monkeypatch):
    """The parameters that `als.fit` gives Spark's ALS, which then does not run."""
    given, real = [], als.ALS

    class Told(real):
        def fit(self, dataset):
            given.append({p.name: v for p, v in self.extractParamMap().items()})

    monkeypatch.setattr(als, "ALS", Told)
    return given


def test_blocks_of_large_inputs_hold_a_bounded_number_of_ratings(spark, monkeypatch):
    given = _params(monkeypatch)
    ratings = spark.range(1000).selectExpr("cast(id % 50 as int) userId", "cast(id as int) productId", "1.0 score")
    als.fit(ratings, 2, 2, 0.1)
    monkeypatch.setattr(als, "BLOCK_RATINGS", 30)
    als.fit(ratings, 2, 2, 0.1)
    assert [(g["numUserBlocks"], g["numItemBlocks"], g["checkpointInterval"]) for g in given] == [(10, 10, 2), (34, 34, 1)]
    assert (given[0]["rank"], given[0]["maxIter"], given[0]["regParam"], given[0]["seed"]) == (2, 2, 0.1, 42)


def test_grid_keeps_its_tables_on_disk_and_few_fits_of_large_ones(spark, monkeypatch):
    lab = als.hash_split(adapters.ratings(spark, SF_SMALL))
    train, test = lab.where("split = 'train'"), lab.where("split = 'test'")
    running, most, levels = [], [], []
    fit = als.fit

    def counted(data, *a):
        running.append(1)
        most.append(len(running))
        levels.append(data.storageLevel)
        try:
            return fit(data, *a)
        finally:
            running.pop()

    monkeypatch.setattr(als, "fit", counted)
    monkeypatch.setattr(als, "GRID_RATINGS", 2 * train.count() - 1)
    grid = als.grid_search(train, test, (2, 3), (0.1,), max_iter=2).collect()
    assert len(grid) == 2 and max(most) == 1
    assert all(x.useDisk and not x.useMemory for x in levels)
