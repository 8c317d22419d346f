import numpy as np
import pytest

from shelfrank.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def _plain(rows, link=0.93):
    """n_links and component of each usable row by comparing all pairs."""
    ok = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.float64(np.float32(rows[i][1])) for i in ok}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    n, parent = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, i in enumerate(ok):
        for j in ok[x + 1 :]:
            if rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= link:
                n[i] += 1
                n[j] += 1
                parent[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((r[0], n[i], least[top(i)], r[0] == least[top(i)]) for i, r in enumerate(rows)), key=str)


def _got(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted((tuple(r) for r in near_vectors.near_duplicates(df, **kw).collect()), key=str)


def _about(dice, centre, noise, n):
    return centre + dice.normal(size=(n, len(centre))) * noise / np.sqrt(len(centre))


def _vectors():
    dice = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        centres = dice.normal(size=(4, 32))
        for c in centres:
            c /= np.linalg.norm(c)
            # Tight copies, copies about as far as the link, and copies further than it.
            for noise, n in ((0.05, 40), (0.27, 30), (0.4, 20)):
                rows += [(v.tolist(), label) for v in _about(dice, c, noise, n)]
        rows += [(v.tolist(), label) for v in dice.normal(size=(100, 32))]
        rows += [(centres[0].tolist(), label)] * 30 + [((3 * centres[0]).tolist(), label)] * 5
    rows = [rows[i] for i in dice.permutation(len(rows))]
    return [(i + 100, *r) for i, r in enumerate(rows)]


def test_equal_to_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "RECALL", 1 - 1e-9)
    rows = _vectors()
    assert _got(spark, rows) == _plain(rows)


def test_recall_at_the_threshold(spark):
    """Single pairs at a cosine just above the link are found as often as stated."""
    dice = np.random.default_rng(4)
    rows, n = [], 300
    for i in range(n):
        a, b = dice.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (0.9301 * a + np.sqrt(1 - 0.9301**2) * b).tolist(), 1)]
    met = sum(r[1] for r in _got(spark, rows)) / 2
    assert met / n >= 0.96  # RECALL is 0.99
    k, tables = near_vectors.tables(1000)
    assert near_vectors.tables(10**9) > (k, tables)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [0.5, 0.5, 0.25]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 0.0], 1), (5, [nan, 1.0, 0.0], 1), (6, [inf, 1.0, 0.0], 1),
        (7, good, None), (8, good, None), (9, good, 1), (10, good, 1), (11, good, 2), (12, [1.0, 1.0, 0.5], 1), (13, [0.5, 0.5], 1),
        (13, [0.5, 0.5], 1), (None, good, 1), (None, [0.0, 1.0, -5.0], 3), (14, [1e30, 1e30, 5e29], 1), (15, [1e-30, 1e-30, 5e-31], 1),
        (16, [-0.0, 1.0, 0.0], 4), (17, [0.0, 1.0, 0.0], 4),
    ]
    want = [(a, n, c, a == c) for a, n, c, _ in _plain(rows)]
    assert _got(spark, rows) == sorted(want, key=str)
    assert _got(spark, []) == []


def test_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("node", "vector", "Bucket", "ball", "n_links", "first", "m", "comp"):
        df = df.selectExpr("*", f"'x' as {name}")
    assert sorted(map(tuple, near_vectors.near_duplicates(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


@pytest.mark.parametrize("n", [400, 1600])
def test_near_copies_form_few_pairs(spark, n):
    """Balls, and pairs of balls that meet, do not grow with the square of a group."""
    dice = np.random.default_rng(5)
    centre = dice.normal(size=64)
    vectors = _about(dice, centre / np.linalg.norm(centre), 0.1, n).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], SCHEMA)
    nodes = near_vectors._nodes(df.withColumnRenamed("embedding", "vector"))
    buckets = near_vectors._buckets(nodes, near_vectors.LINK)
    balls = near_vectors._balls(nodes, buckets, near_vectors.LINK)
    assert balls.select("ball").distinct().count() < 30
    out = near_vectors.near_duplicates(df).collect()
    assert {(r.n_links, r.component_id) for r in out} == {(n - 1, 0)}
