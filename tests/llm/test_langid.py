import math
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(spark.read.parquet(f"{SF}/documents.parquet"), per_lang=60)


def brute_bits(rows, lang, raw):
    """Code length by definition: longest context in the tree, escapes below it."""
    tree = {(r[1], r[2]) for r in rows} | {(0, 0)}
    counts = defaultdict(lambda: defaultdict(int))
    for l, order, ctx, sym, n in rows:
        if l == lang:
            counts[order, ctx][sym] += n

    def p(order, ctx, sym):
        if order < 0:
            return 1 / 256
        seen = counts[order, ctx]
        below = lambda: p(order - 1, ctx & ((1 << 8 * max(0, order - 1)) - 1), sym)
        if not seen:
            return below()
        n, d = sum(seen.values()), len(seen)
        return seen[sym] / (n + d) if sym in seen else d / (n + d) * below()

    total = 0.0
    for i, sym in enumerate(raw):
        for k in range(min(i, langid.MAX_ORDER), -1, -1):
            ctx = int.from_bytes(raw[i - k : i], "big")
            if (k, ctx) in tree:
                total -= math.log2(p(k, ctx, sym))
                break
    return total


def test_code_lengths_are_exact(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 400")
    rows = [tuple(r) for r in langid.training_sample(docs, 5).mapInArrow(langid._count_contexts, langid._COUNTS).collect()]
    total = defaultdict(int)
    for l, order, ctx, sym, n in rows:
        total[order, ctx] += n
    kept = set(sorted(total, key=lambda c: (-total[c], c))[:300])
    merged = defaultdict(int)
    for l, order, ctx, sym, n in rows:
        if (order, ctx) in kept:
            merged[l, order, ctx, sym] += n
    rows = [(*k, n) for k, n in merged.items()]
    model = langid.build_model(rows)
    raw = [b"", b"a", "Die größte Straße, and the thing. ".encode() * 30, bytes(range(256)) * 3]
    got = langid.code_lengths(model, raw)
    want = np.array([[brute_bits(rows, l, r) for l in model.langs] for r in raw])
    assert np.allclose(got, want, rtol=1e-5, atol=1e-3)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, (lang, score, _) = langid.identify(docs, model)
    held = rows.where(langid.held_out()).select("lang", lang, score).collect()
    assert sum(r[0] == r[1] for r in held) >= 0.97 * len(held)
    assert all(0 <= r[2] <= 1 for r in held)


def test_edge_rows(docs, nothing, model):
    rows, (lang, score, rate) = langid.identify(docs, model)
    assert score != "score"
    found = rows.collect()
    assert len(found) == docs.count()
    und = {r["doc_id"] for r in found if r[lang] == "und"}
    assert und == {2, 3, 4, 11}
    assert all((r[score] == 0) == (r["doc_id"] in und) for r in found)
    assert langid.identify(nothing, model)[0].collect() == []
    assert langid.train(nothing) is None
    assert {r[lang] for r in langid.identify(docs, None)[0].select(lang).collect()} == {"und"}


def test_inputs_are_text_alone(spark, model):
    texts = ["The thing and the other of them", "Die und der Straße nicht"]
    a = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    b = spark.createDataFrame([(i + 100, t, "y") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    read = lambda d: sorted(tuple(r)[1:2] + tuple(r)[3:] for r in langid.identify(d, model)[0].collect())
    assert read(a) == read(b)


def test_rare_languages_have_contexts_of_their_own(spark):
    """Two languages at 2 % of the documents each, alike in letters but not in
    their order, beside one that has contexts enough to fill the tree."""
    dice = random.Random(3)
    many, few = (["".join(dice.choice(a) for _ in range(5)) for _ in range(n)] for a, n in (("abcdefgh", 600), ("mnopqrst", 20)))
    words = {"main": many, "left": few, "right": [w[::-1] for w in few]}
    text = lambda lang, n: " ".join(dice.choice(words[lang]) for _ in range(n))
    langs = [{0: "left", 25: "right"}.get(i % 50, "main") for i in range(600)]
    docs = spark.createDataFrame([(i, text(k, 60), k) for i, k in enumerate(langs)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    for lang in words:
        got = langid.decide(model, [text(lang, 3).encode() for _ in range(200)])[0]
        assert got.count(lang) >= 0.97 * len(got), (lang, got.count(lang))


def test_contexts_pay(spark):
    """Kept contexts are a tree, hold what saves the most, and none besides."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 600")
    counts = langid.training_sample(docs, 20).mapInArrow(langid._count_contexts, langid._COUNTS)
    counts = counts.groupBy("lang", "ctx_order", "ctx", "sym").sum("n").withColumnRenamed("sum(n)", "n").checkpoint()
    n = defaultdict(dict)
    for r in counts.collect():
        n[r.lang, r.ctx_order, r.ctx][r.sym] = r.n
    short = lambda k, c: (k - 1, c & ((1 << 8 * (k - 1)) - 1))
    bits = lambda seen, sym: -math.log2(seen[sym] / (sum(seen.values()) + len(seen)))
    pays, share = set(), 1e-3
    least = {lang: max(16, share * sum(m * bits(seen, s) for s, m in seen.items())) for (lang, k, _), seen in n.items() if not k}
    for (lang, k, c), seen in n.items():
        if k and sum(m * (bits(n[lang, *short(k, c)], s) - bits(seen, s)) for s, m in seen.items()) >= least[lang]:
            pays.add((lang, k, c))
    tree = {(lang, 0, 0) for lang, _, _ in n}
    while pays:
        tree |= pays
        pays = {(lang, *x) for lang, k, c in pays if k for x in (short(k, c), (k - 1, c >> 8))}
    assert {tuple(r) for r in langid._paying(counts, share).collect()} == tree and len(tree) > 50


def test_other_languages_change_nothing(spark):
    """Code lengths of a language are the same with and without the others."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = docs.select("lang").where("lang is not null").agg({"lang": "min"}).first()[0]
    raw = [r.text.encode() for r in docs.where("length(text) between 50 and 300").limit(40).collect()]
    alone = langid.train(docs.where(docs.lang == one), 40)
    among = langid.train(docs, 40)
    a, b = langid.code_lengths(alone, raw), langid.code_lengths(among, raw)
    assert len(among.langs) > 1 and np.allclose(a[:, 0], b[:, among.langs.index(one)], rtol=1e-5)


def test_model_is_built_in_little_memory(spark):
    counts = langid.training_sample(spark.read.parquet(f"{SF}/documents.parquet"), 60).mapInArrow(
        langid._count_contexts, langid._COUNTS
    )
    counts = counts.groupBy("lang", "ctx_order", "ctx", "sym").agg(F.sum("n").alias("n")).checkpoint()
    paying = langid._paying(counts, langid.SAVED_SHARE)
    assert paying._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1  # not one a round
    rows = counts.join(paying, ["lang", "ctx_order", "ctx"]).select(*langid._COUNTS.fieldNames()).toArrow()
    tracemalloc.start()
    built = langid.build_model(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * (built.step.nbytes + built.cost.nbytes)
    again = langid.build_model([tuple(r.values()) for r in rows.to_pylist()])
    assert built.langs == again.langs and np.array_equal(built.step, again.step) and np.array_equal(built.cost, again.cost)
