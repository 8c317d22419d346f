import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from shelfrank.operators import blocked, cooccur, impact, packed, pivots, similarity, waves
from shelfrank.sources import adapters


def factor_df(spark, vecs):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vecs.items()], "id int, features array<double>")


def test_f5_zero_vector_dropped(spark):
    f = factor_df(spark, {1: [0, 0], 2: [1, 0], 3: [2, 0]})
    out = similarity.cosine_similarity(f, 0.6)
    assert [(a, b, round(s, 9)) for a, b, s in rows(out)] == [(2, 3, 1.0), (3, 2, 1.0)]


def test_f6_exact_threshold_dropped(spark):
    f = factor_df(spark, {1: [1.0, 0.0], 2: [0.6, 0.8]})
    assert similarity.cosine_similarity(f, 0.6).count() == 0
    assert similarity.cosine_similarity(f, 0.59).count() == 2


def test_blocked_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    vecs = {i: rng.normal(size=8) for i in range(150)}
    f = factor_df(spark, vecs)
    v = f.withColumnRenamed("features", "v")
    # 40-row blocks: several block pairs, both same-block and cross-block tasks.
    got = pivots.cosine_join(v, "id", "v", 0.3, block_rows=40)
    got = {(a, b): s for a, b, s in rows(got)}
    exp = {}
    for i, a in vecs.items():
        for j, b in vecs.items():
            if i != j:
                c = float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
                if c > 0.3:
                    exp[(i, j)] = c
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)
    assert all(got[(a, b)] == got[(b, a)] for a, b in got)
    assert all(-1 <= s <= 1 + 1e-12 for s in got.values())


def test_factor_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    users = {i: rng.normal(size=6) for i in range(60)}
    items = {100 + i: rng.normal(size=6) for i in range(90)}
    out = similarity.factor_top_k(factor_df(spark, users), factor_df(spark, items), k=5, block_rows=25)
    got = defaultdict(list)
    for r in out.orderBy("userId", "rank").collect():
        got[r["userId"]].append(r["productId"])
    for u, uv in users.items():
        scores = sorted(((-(uv @ iv), i) for i, iv in items.items() if uv @ iv > 0))
        assert got.get(u, []) == [i for _, i in scores[:5]]


def test_cooccurrence_matches_brute_force(spark):
    ratings = adapters.ratings(spark, SF_SMALL)
    out = similarity.cooccurrence_similarity(ratings, min_support=2, k=None)
    got = {(r["productId"], r["simId"]): r["sim"] for r in out.collect()}
    users = defaultdict(set)
    for r in ratings.select("userId", "productId").collect():
        users[r["userId"]].add(r["productId"])
    n = Counter(p for s in users.values() for p in s)
    pairs = Counter((a, b) for s in users.values() for a in s for b in s if a != b)
    exp = {k: c / math.sqrt(n[k[0]] * n[k[1]]) for k, c in pairs.items() if c >= 2}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_content_top_k_matches_brute_force(spark):
    prods = spark.createDataFrame(
        [
            (1, "a|b|c"), (2, "a|b|c"), (3, "a|b"), (4, "c|d"), (5, "d"), (6, "x|y"),
            (7, "a|b|c"), (8, "b|c"), (9, "common"), (10, "a|common"), (11, None),
        ],
        "productId int, tags string",
    )
    k = 3
    out = similarity.content_similarity(prods, k=k)
    got = defaultdict(list)
    for r in out.orderBy("productId", "rank").collect():
        got[r["productId"]].append((r["simId"], round(r["sim"], 9)))
    # brute force
    toks = {p: t.split("|") for p, t in prods.collect() if t}
    n = len(toks)
    df = Counter(t for ts in toks.values() for t in set(ts))
    vec = {p: {t: c * math.log((n + 1) / (df[t] + 1)) for t, c in Counter(ts).items()} for p, ts in toks.items()}
    exp = {}
    for a, va in vec.items():
        na = math.sqrt(sum(w * w for w in va.values()))
        if na == 0:
            continue
        cands = []
        for b, vb in vec.items():
            nb = math.sqrt(sum(w * w for w in vb.values()))
            if b == a or nb == 0:
                continue
            s = sum(w * vb.get(t, 0.0) for t, w in va.items()) / (na * nb)
            if s > 0:
                cands.append((-round(s, 9), b))
        exp[a] = [(b, -s) for s, b in sorted(cands)[:k]]
    exp = {a: v for a, v in exp.items() if v}
    assert dict(got) == exp


def test_kernels_chunked_equal_unchunked():
    rng = np.random.default_rng(11)
    a = rng.normal(size=(70, 5))
    ua = a / np.linalg.norm(a, axis=1)[:, None]
    ids = np.arange(70)
    full = blocked.threshold_pairs(ids, ua, ids, ua, 0.2, same=True, chunk=1000)
    small = blocked.threshold_pairs(ids, ua, ids, ua, 0.2, same=True, chunk=7)
    assert sorted(zip(*[x.tolist() for x in full])) == sorted(zip(*[x.tolist() for x in small]))
    b = rng.normal(size=(33, 5))
    f2 = blocked.row_top_k(ids, np.arange(33), a, b, 4, True, chunk=1000)
    s2 = blocked.row_top_k(ids, np.arange(33), a, b, 4, True, chunk=5)
    assert sorted(zip(*[x.tolist() for x in f2])) == sorted(zip(*[x.tolist() for x in s2]))


def test_equal_vectors_emit_few_candidates():
    import numpy as np

    from shelfrank.operators import blocked

    same = np.ones((3000, 4))
    r, c, s = blocked.row_top_k(np.arange(3000), np.arange(3000), same, same, 20, True)
    assert len(r) == 3000 * 20 and set(c.tolist()) == set(range(20))


def _sparse(spark, n, seed=4):
    """Vectors with a term that all but a few have, terms that a third have, and
    rare ones; many weights and scores are equal."""
    rng = np.random.default_rng(seed)
    data = []
    for i in range(n):
        terms = {"hot": 1.0} if i % 10 else {}
        terms[f"third{i % 3}"] = float(rng.choice([1, 2]))
        if rng.random() < 0.6:
            terms[f"rare{rng.integers(n // 4)}"] = float(rng.choice([1, 3, 5]))
        if rng.random() < 0.2:
            terms[f"own{i}"] = 2.0
        data.append((i, sorted(terms), [terms[t] for t in sorted(terms)]))
    return data, spark.createDataFrame(data, "id int, terms array<string>, weights array<double>")


@pytest.mark.parametrize("first_page", [2, 16, 4096])
def test_sparse_top_k_matches_brute_force(spark, monkeypatch, first_page):
    monkeypatch.setattr(impact, "PAGE", first_page)
    data, df = _sparse(spark, 120)
    unit = {i: {t: x / math.sqrt(sum(y * y for y in w)) for t, x in zip(ts, w)} for i, ts, w in data}
    want = {}
    for a, va in unit.items():
        scored = [(-round(sum(x * vb.get(t, 0.0) for t, x in sorted(va.items())), 9), b) for b, vb in unit.items() if b != a]
        want[a] = [b for s, b in sorted(scored)[:5] if s < 0]
    got = defaultdict(list)
    order = ["a", F.round("sim", 9).desc(), "b"]
    for r in impact.top_k_sparse(df, 5).orderBy(*order).collect():
        got[r.a].append(r.b)
    assert dict(got) == want


def test_hot_terms_are_read_by_pages(spark, monkeypatch):
    """A term that nine tenths of all vectors have: a vector meets few of them."""
    monkeypatch.setattr(impact, "PAGE", 8)
    _, df = _sparse(spark, 2000)
    postings, pages = impact.inverted_index(df)
    assert postings.where("term = 'hot'").count() == 1800
    assert pages.where("term = 'hot'").count() == 8 and pages.where("term = 'hot' and ended").count() == 1
    met, dot = [], impact._dot
    monkeypatch.setattr(impact, "_dot", lambda: met.append(1) or dot())
    assert impact.top_k_sparse(df, 5).count() == 2000 * 5
    assert len(met) <= 7  # rounds; all vectors reading all pages would take 8


def test_rank_all_computes_its_input_once(spark):
    from pyspark.sql import functions as F

    from shelfrank.operators.topk import rank_all

    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = spark.range(1000).repartition(4).mapInArrow(count, "id long")
    out = rank_all(df.withColumn("g", F.col("id") % 3), "g", [F.col("id").asc()])
    assert out.count() == 1000 and calls.value == 1000


def _clustered(clusters, each, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return {c * each + i: centres[c] + 0.25 * rng.normal(size=dim) for c in range(clusters) for i in range(each)}


def _cosine_pairs(vecs, threshold):
    ids = np.array(list(vecs))
    unit = np.array([v / np.linalg.norm(v) for v in vecs.values()])
    a, b = np.nonzero(unit @ unit.T > threshold)
    return {(int(ids[i]), int(ids[j])) for i, j in zip(a, b) if i != j}


def test_pivots_lose_no_pair(spark):
    for threshold in (0.6, 0.95, -0.2):
        vecs = _clustered(12, 25)
        got = pivots.cosine_join(factor_df(spark, vecs), "id", "features", threshold, block_rows=15)
        got = [(a, b) for a, b, _ in rows(got)]
        assert len(got) == len(set(got)) and set(got) == _cosine_pairs(vecs, threshold)


def test_pivots_prune_clustered_blocks(spark):
    """With the number of clusters the blocks multiplied grow far slower than their pairs."""
    shares = []
    for clusters in (8, 32):
        made = pivots.plan(factor_df(spark, _clustered(clusters, 50)), "id", "features", 0.9, 50)
        kept, whole = made.block_pairs()
        assert made.blocks >= clusters
        shares.append(kept / whole)
    assert shares[0] < 0.6 and shares[1] < 0.4 * shares[0] + 0.1


def test_pivots_copy_rows_to_blocks_in_reach(spark):
    vecs = _clustered(16, 40)
    made = pivots.plan(factor_df(spark, vecs), "id", "features", 0.9, 40)
    unit = np.array([v / np.linalg.norm(v) for v in vecs.values()])
    block, partners = made.deal(np.arange(len(unit)), unit)
    assert all(b in p for b, p in zip(block, partners))
    assert np.mean([len(p) for p in partners]) < made.blocks / 2


def test_pivots_on_equal_vectors(spark):
    vecs = {i: np.array([1.0, 2.0, 3.0]) for i in range(100)}
    got = similarity.cosine_similarity(factor_df(spark, vecs), 0.6, block_rows=10)
    assert got.count() == 100 * 99
    assert similarity.cosine_similarity(factor_df(spark, vecs).limit(0)).count() == 0


def _best(users, items, k, positive):
    out = {}
    for u, uv in users.items():
        scores = sorted((-round(float(uv @ iv), 9), i) for i, iv in items.items() if not positive or uv @ iv > 0)
        out[u] = [i for _, i in scores[:k]]
    return {u: v for u, v in out.items() if v}


def test_waves_stop_early_and_lose_nothing(spark):
    """Norms that fall off: most users are done after the first waves."""
    rng = np.random.default_rng(8)
    users = {i: rng.normal(size=6) for i in range(80)}
    users[99] = np.zeros(6)
    items = {i: rng.normal(size=6) / (1 + i / 20) ** 2 for i in range(1000)}
    for positive in (True, False):
        out, report = waves.top_k_by_norm(factor_df(spark, users), factor_df(spark, items), 5, positive, block_rows=40)
        got = defaultdict(list)
        for r in out.orderBy("userId", "rank").collect():
            got[r["userId"]].append(r["productId"])
        want = _best(users, items, 5, positive)
        if not positive:  # all scores of the zero user are equal: the lowest ids
            assert got[99] == [0, 1, 2, 3, 4]
        assert dict(got) == want
    met = [w.users for w in report]
    assert met[0] == 81 and met == sorted(met, reverse=True) and met[-1] <= 8
    assert sum(w.copies for w in report) < 81 * 25 + 1000 * 3


def test_waves_with_equal_norms_and_few_items(spark):
    users = {1: np.array([1.0, 0.0]), 2: np.array([-1.0, 0.0])}
    items = {i: np.array([1.0, 0.0]) for i in range(30)}
    out = similarity.factor_top_k(factor_df(spark, users), factor_df(spark, items), 4, block_rows=5)
    assert [(r.userId, r.productId) for r in out.orderBy("userId", "rank").collect()] == [(1, i) for i in range(4)]
    none = similarity.factor_top_k(factor_df(spark, users), factor_df(spark, items).limit(0), 4)
    assert none.count() == 0


def test_ranked_pairs_are_planned_with_their_size(spark):
    """Joins with ranked pairs go by the size of the pairs, not by that of the few
    vectors they come of, which made the driver broadcast them."""
    f = factor_df(spark, {i: [1.0, i / 1000] for i in range(400)})
    ranked = similarity.rank_similar(similarity.cosine_similarity(f, 0.5))
    size = int(str(ranked._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert ranked.count() == 400 * 399 and size > 400 * 399


def test_rank_all_leaves_out_null_groups_and_numbers_strings(spark):
    from shelfrank.operators.topk import rank_all

    df = spark.createDataFrame([("a", 2), (None, 5), ("b", 1), ("a", 1), (None, 4)], "g string, v int")
    for parts in (1, 3, None):
        got = rank_all(df, "g", [F.col("v").asc()], partitions=parts)
        assert got.columns == ["g", "v", "rank"] and rows(got) == [("a", 1, 1), ("a", 2, 2), ("b", 1, 1)]


def test_wide_blocks_give_few_candidates():
    """The bound of groups of columns keeps the top k, and little more."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(40, 8)), rng.normal(size=(6000, 8))
    r, c, s = blocked.row_top_k(np.arange(40), np.arange(6000), a, b, 20, True)
    exact = a @ b.T
    for u in range(40):
        assert set(np.argsort(-exact[u])[:20]) <= set(c[r == u])
    assert len(r) < 40 * 20 * 1.5
    few = np.where(np.arange(6000) % 1500 == 0, 1.0, -1.0)[:, None]  # fewer than k above 0
    r, c, _ = blocked.row_top_k(np.arange(2), np.arange(6000), np.ones((2, 1)), few, 20, True)
    assert sorted(zip(r.tolist(), c.tolist())) == [(u, i) for u in range(2) for i in range(0, 6000, 1500)]


def test_pairs_touching_some_products(spark):
    """The pairs of the products asked for, out of several blocks and of one."""
    rng = np.random.default_rng(13)
    f = factor_df(spark, {i: rng.normal(size=8) for i in range(150)})
    asked = spark.createDataFrame([(3,), (3,), (40,), (149,), (999,), (None,)], "productId int")
    whole = rows(similarity.cosine_similarity(f, 0.3))
    exp = [r for r in whole if {r[0], r[1]} & {3, 40, 149}]
    assert 0 < len(exp) < len(whole)
    for block in (40, 2048):
        assert rows(similarity.cosine_similarity(f, 0.3, block_rows=block, touching=asked)) == exp
    assert similarity.cosine_similarity(f, 0.3, touching=asked.limit(0)).count() == 0


def test_content_lists_without_a_row_per_candidate_in_sorts(spark):
    """Products of one large profile: the lists are whole, and no window sorts a
    row for each product and candidate."""
    prods = spark.createDataFrame([(i, "a|b") for i in range(300)] + [(1000 + i, "c|d") for i in range(3)], "productId int, tags string")
    out = similarity.content_similarity(prods, k=4)
    got = defaultdict(list)
    for r in out.orderBy("productId", "rank").collect():
        got[r["productId"]].append((r["rank"], r["simId"]))
    for i in range(300):
        assert got[i] == list(enumerate([j for j in range(5) if j != i][:4], 1))
    assert got[1001] == [(1, 1000), (2, 1002)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan.split("Window")[0]  # nothing is sorted after the lists are spread


def test_cooccurrence_joins_counts_before_pairs(spark):
    """Pairs carry their products' counts, light and heavy users' alike."""
    data = [(u, p) for u in range(30) for p in range(12) if (u * p) % 5 < 3] + [(99, p) for p in range(40)]
    up = spark.createDataFrame(data, "userId int, productId int")
    n_item = up.groupBy("productId").agg(F.count("*").alias("n"))
    for heavy in (20, 1000):
        pairs = cooccur.pair_counts(up, heavy, n_item)
        assert rows(cooccur.scored(pairs, n_item, 1)) == rows(cooccur.scored(cooccur.pair_counts(up, heavy), n_item, 1))
        joins = pairs._jdf.queryExecution().optimizedPlan().toString().count("Join Inner")
        assert heavy == 20 or joins <= 3  # users' pairs, and the counts on each side


def test_packed_lists_come_back():
    rng = np.random.default_rng(2)
    size = np.append([0, 0], rng.integers(0, 30, 50))
    ids = np.concatenate([np.sort(rng.choice(2**32 - 1, n, replace=False) - 2**31) for n in size]).astype(np.int64)
    codes = rng.integers(0, 1 << rng.integers(1, 40), len(ids))
    data, ends = packed.encode(ids, codes, size)
    back, code, row = packed.decode(data, ends)
    assert (back == ids).all() and (code == codes).all() and (row == np.repeat(np.arange(len(size)), size)).all()


def test_best_rows_keep_all_that_rounding_may_rank():
    """Ties by position, and scores that engines may round up or down."""
    half = 0.5000000015  # between two rounded values
    score = np.array([0.2, 0.9, 0.2, 0.2, half, 0.500000001, 0.500000002, 0.1])
    assert packed.best_rows(np.zeros(8, int), score, 1).tolist() == [1]
    assert packed.best_rows(np.repeat([0, 4], 4), score, 2).tolist()[:2] == [1, 0]
    assert {4, 5, 6} <= set(packed.best_rows(np.repeat([0, 3], 4), score, 2).tolist())


def _counted(data, k, support):
    users = defaultdict(set)
    for u, p in data:
        users[u].add(p)
    n = Counter(p for _, p in set(data) if p is not None)
    pairs = Counter((a, b) for u, s in users.items() if u is not None for a in s for b in s if None not in (a, b) and a != b)
    out = defaultdict(list)
    for (a, b), c in pairs.items():
        if c >= support:
            out[a].append((-round(c / math.sqrt(n[a] * n[b]), 9), b))
    return {a: [b for _, b in sorted(v)[:k]] for a, v in out.items()}


@pytest.mark.parametrize("heavy,hot,entries,meet", [(1000, 4096, 1 << 25, 1 << 19), (1000, 4096, 300, 40), (1000, 8, 300, 40), (20, 4096, 300, 1 << 19), (6, 8, 100, 10)])
def test_best_pairs_by_lists(spark, heavy, hot, entries, meet):
    """Many and few blocks; products of many users, users of many products, null
    ids, negative ids and ties."""
    rng = np.random.default_rng(heavy + hot)
    data = [(int(u), int(p) - 40) for u, p in zip(rng.integers(0, 60, 500), rng.integers(0, 90, 500) ** 2 // 90)]
    data += [(99, p) for p in range(-40, 10)] + [(None, 3), (None, -7), (5, None), (6, None)]
    df = spark.createDataFrame(data, "userId int, productId int")
    up = df.distinct()
    n_item = up.groupBy("productId").agg(F.count("*").alias("n"))
    for support in (1, 2):
        best = similarity.rank_similar(cooccur.top_pairs(up, n_item, 4, support, heavy, hot, entries, meet), 4)
        got = defaultdict(list)
        for r in best.orderBy("productId", "rank").collect():
            got[r.productId].append(r.simId)
        assert dict(got) == _counted(data, 4, support)


def test_itemcf_deals_out_no_row_per_pair(spark):
    """120 users of 40 products each: 93,600 pairs, of which a product keeps 5."""
    rng = np.random.default_rng(1)
    data = [(u, int(p), 1.0) for u in range(120) for p in rng.choice(2000, 40, replace=False)]
    df = spark.createDataFrame(data, "userId int, productId int, score double")
    out = similarity.cooccurrence_similarity(df, k=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("WindowGroupLimit") :]
    assert "SortMergeJoin" not in before.split("MapInArrow")[0] and "BroadcastHashJoin" not in before.split("MapInArrow")[0]
    got = defaultdict(list)
    for r in out.orderBy("productId", "rank").collect():
        got[r.productId].append(r.simId)
    assert dict(got) == _counted([d[:2] for d in data], 5, 1)


@pytest.mark.parametrize("least", [2048, 20])
def test_ranked_lists_equal_ranked_pairs(spark, monkeypatch, least):
    """Lists made in tasks, of one block and of several that pivots prune, are those
    that dealing out all pairs gives; ids may be negative, cosines too."""
    from shelfrank.operators.topk import rank_all

    monkeypatch.setattr(blocked, "LEAST_BLOCK_ROWS", least)
    vecs = {i - 100: v for i, v in _clustered(6, 40, 8).items()}
    vecs |= {500 + i: vecs[i - 100] for i in range(12)} | {999: np.zeros(8)}  # ties
    f = factor_df(spark, vecs)
    for threshold in (0.6, -0.3):
        got = rows(similarity.ranked_cosines(f, threshold).select("productId", "rank", "simId", "sim"))
        pairs = similarity.cosine_similarity(f, threshold)
        want = rank_all(pairs, "productId", [F.round("sim", 9).desc(), F.col("simId").asc()])
        assert got == rows(want.select("productId", "rank", "simId", "sim")) and len(got) > 100
    assert similarity.ranked_cosines(f.limit(0)).count() == 0


def test_ranked_cosines_deal_out_vectors_and_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    f = factor_df(spark, {i: rng.normal(size=8) for i in range(300)})
    ranked = similarity.ranked_cosines(f, 0.1)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("MapInArrow")[0] and "Sort" not in plan
    monkeypatch.setattr(pivots, "LIST_CELLS", 100)  # too many vectors for a task
    assert rows(similarity.ranked_cosines(f, 0.1)) == rows(ranked)


def test_rank_keys_round_as_spark_does(spark):
    rng = np.random.default_rng(6)
    values = [0.0, 1.0, -1.0, 0.1234567885, -0.1234567885, 0.5000000015, 0.9999999995, 1.0000000000000002]
    values += (np.round(rng.uniform(-1, 1, 200), 9) + 5e-10).tolist() + rng.uniform(-1, 1, 200).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = [r.v for r in df.select(F.round("v", 9).alias("v")).collect()]
    assert (pivots._rank_keys(np.array(values)) / 1e9).tolist() == want


def test_pages_of_runs_need_no_shuffle(spark):
    """Pages of lists that lie in order, over batches and pages, and of torn lists."""
    from shelfrank.operators import topk

    data = [(p, s, 1.0 / (s + 1), s + 1) for p in range(7) for s in range(3 * p)]
    for cut in (len(data), 11):  # the second part begins within a list
        df = spark.createDataFrame(data[:cut], "productId int, simId int, sim double, rank int").coalesce(1)
        if cut < len(data):
            df = df.unionByName(spark.createDataFrame(data[cut:], df.schema).coalesce(1))
        old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
        try:
            paged = topk.nest(df, "productId", "simId", "sim", rank_col="rank", page_size=5, runs=True)
            assert "Exchange" not in paged._jdf.queryExecution().executedPlan().toString()
            whole = topk.nest(df, "productId", "simId", "sim", rank_col="rank", page_size=5)
            assert paged.schema == whole.schema or paged.columns == whole.columns
            if cut == len(data):
                assert rows(paged) == rows(whole)
            assert max(len(r.recs) for r in paged.collect()) <= 5
            assert rows(topk.unnest(paged, "productId")) == sorted((p, r, s, v) for p, s, v, r in data)
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_similarity_queries_deal_out_no_pairs(spark, monkeypatch):
    """product_recs_nested, sim_map and the table of stream_recs: no pair is written
    to be ranked."""
    from shelfrank.operators import topk
    from shelfrank.plans import catalog

    monkeypatch.setattr(topk, "rank_all", None)
    monkeypatch.setattr(similarity, "rank_all", None)
    for query in (catalog.q_product_recs_nested, catalog.q_sim_map):
        plan = query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("MapInArrow")[0]


def test_vectors_of_one_id_have_one_list(spark):
    rng = np.random.default_rng(9)
    f = factor_df(spark, {i: rng.normal(size=6) for i in range(60)})
    twice = f.unionByName(f.where("id < 9")).unionByName(factor_df(spark, {3: rng.normal(size=6)}))
    got = similarity.ranked_cosines(twice, 0.2)
    want = similarity.rank_similar(similarity.cosine_similarity(twice, 0.2))
    part = lambda df: rows(df.select("productId", "rank", F.round("sim", 9)))
    assert part(got) == part(want)
    assert got.select("productId", "rank").distinct().count() == got.count()
