import random
import re
import tracemalloc

import pytest

from shelfrank.llm import jaccard

from .conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(
        ((d, len(s), (least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr
    )


def run(spark, rows, parts=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted(map(tuple, jaccard.classes(docs).collect()), key=repr)


def near(dice, words, share):
    return [dice.choice("abcdefgh") * 3 if dice.random() < share else w for w in words]


def corpus(seed):
    """Chains of edits, a large family, a passage that many share, tiny texts."""
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    fresh = lambda n: [dice.choice(vocabulary) for _ in range(n)]
    texts = []
    for _ in range(6):
        words = fresh(60)
        for _ in range(5):  # each a little further from the first
            texts.append(words)
            words = near(dice, words, 0.02)
    base = fresh(90)
    texts += [near(dice, base, dice.choice([0, 0.005, 0.01, 0.02, 0.04])) for _ in range(60)]
    passage = fresh(50)
    for n in (2, 5, 9, 12, 15, 18, 25, 60):
        texts += [passage + fresh(n) for _ in range(6)]
    texts += [fresh(n) for n in (1, 1, 2, 3, 4, 5, 5, 6, 7, 8) for _ in range(2)]
    texts += [["a"], ["a"], ["a", "b"], list("abcdef"), list("abcdefg"), list("abcdefgh")]
    rows = [(i * 3 + 1, " ".join(t)) for i, t in enumerate(texts)]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_frequent_shingles_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", 8)
    monkeypatch.setattr(jaccard, "FREQUENT_SHARE", 30)
    monkeypatch.setattr(jaccard, "BUCKET_SHINGLES", 500)
    rows = corpus(3)
    assert run(spark, rows, 1) == brute(rows)


def test_edge_rows(spark, docs):
    got = sorted(map(tuple, jaccard.classes(docs).collect()), key=repr)
    assert got == brute(ROWS)


def test_empty_tables(spark, nothing):
    assert jaccard.classes(nothing).collect() == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_components_join_long_chains(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(0, 40)], "a binary, b binary")
    assert {bytes(r.comp) for r in jaccard.components(links).collect()} == {bytes([0])}


def _family(n, shared, own, seed=9):
    """Texts that share a passage too short for a link, but for a few pairs."""
    dice = random.Random(seed)
    passage = [f"p{i}" for i in range(shared)]
    texts = []
    for i in range(n):
        tail = [f"o{dice.randrange(40)}" for _ in range(own)]
        texts.append(passage + tail)
        if i % 20 == 0:
            texts.append(passage + tail[:-1])
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_large_family_that_mostly_does_not_link(spark):
    rows = _family(240, 30, 14)
    got = run(spark, rows)
    assert got == brute(rows)
    assert len(rows) == 252 and len({c for _, _, c in got}) == 240


def test_the_other_orders_remove_candidates(spark):
    """Of pairs that meet in prefixes of order 1, no pair that links is removed,
    and both other orders remove some on their own."""
    from pyspark.sql import functions as F

    dice = random.Random(12)
    passages = [" ".join(f"p{i}w{j}" for j in range(20)) for i in range(40)]
    rows = [(i, " ".join(dice.sample(passages, 5))) for i in range(150)]
    rows += [(1000 + i, t + " end") for i, t in rows[:5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets, common = jaccard.describe(docs)
    nodes = jaccard.shared(docs, 10_000, jaccard.frequent(common, 10**6)).checkpoint()
    at = nodes.select(F.explode("p1").alias("t"), "node")
    pairs = at.alias("x").join(at.alias("y"), "t").where("x.node < y.node").selectExpr("x.node a", "y.node b").distinct()
    found = jaccard._filtered(pairs, nodes).checkpoint()
    sides = found.join(nodes.selectExpr("node a", "n an", "ids ai"), "a").join(nodes.selectExpr("node b", "n bn", "ids bi"), "b")
    common = F.size(F.array_intersect("ai", "bi"))
    linked = sides.where(100 * common >= 75 * (F.col("an") + F.col("bn") - common))
    assert linked.count() and linked.where("not (meet2 and meet3)").isEmpty()
    kept = {(r.meet2, r.meet3): r["count"] for r in found.groupBy("meet2", "meet3").count().collect()}
    assert all(any(not k[i] for k in kept) for i in (0, 1)), kept


def test_kept_words_take_little_memory():
    """Half a million kept words took some 100 MB in each of an executor's workers."""
    tracemalloc.start()
    try:
        words = jaccard._Words()
        for i in range(200_000):
            words[b"word%07d" % i]
        taken = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert taken < 10e6
    assert words[b"word0000003"] == jaccard._Words()[b"word0000003"]


def test_nodes_are_labelled_again_only_after_new_links(spark, monkeypatch):
    """Each labelling takes some twenty jobs, whose plans and broadcasts the driver holds."""
    calls, label = [], jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda links: calls.append(1) or label(links))
    base = [f"w{i}" for i in range(60)]
    near = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(0, 60, 59)]  # ends: a shingle each
    rows = [*near, (70, " ".join(base)), (71, "one two three four five six seven")]
    assert run(spark, rows) == brute(rows)
    assert len(calls) == 1
    del calls[:]
    assert run(spark, rows[3:]) == brute(rows[3:])  # no links at all
    assert len(calls) == 1
