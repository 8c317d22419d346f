import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from shelfrank.llm import quality

from .conftest import ROWS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    marked = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


TEXTS = [t for _, t in ROWS] + [
    "a b c a b c",
    "x x x x",
    "line one here\nline one here\n \n \nline one here",
    "#*$%&|<> \x0b\x0c\r é\x1cü\x85  z",
    "a b c\na b c a b",
]


def test_counts_equal_brute_force():
    for text in TEXTS:
        got = quality.text_stats(None if text is None else text.encode())
        assert tuple(got[:5]) == brute(text), text


def test_rows_keep_their_columns(docs):
    rows, names = quality.judge(docs, quality.DecisionList())
    assert names["n_words"] != "n_words" and names["kept"] != "kept"
    assert rows.columns[: len(docs.columns)] == docs.columns
    found = rows.collect()
    assert len(found) == len(ROWS)
    for r in found:
        n, _, _, _, repeat = brute(r["text"])
        failed = n < 50 or 100 * repeat > 50 * n
        assert r[names["base_failed"]] == failed and r[names["kept"]] == (not failed)


def test_learned_rules_separate_junk(spark):
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        text = prose(i, 100)
        rows.append((i, " ".join(w + "$$$" for w in text.split()) if bad else text))
        labels.append((i, 0 if bad else 1))
    labels += [(None, 0), (5, None), (9999, 0), (1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rules = quality.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert 1 <= len(rules.rules) <= 3
    judged, names = quality.judge(docs, rules)
    for r in judged.collect():
        assert r[names["kept"]] == (r["doc_id"] % 3 != 0)
    assert "CASE WHEN" in judged._jdf.queryExecution().analyzed().toString()


def test_no_labels_learn_nothing(spark, docs, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.learn(docs, none).rules == ()
    good = spark.createDataFrame([(1, 1), (5, 1)], "doc_id long, quality int")
    assert quality.learn(docs, good).rules == ()
    assert quality.judge(nothing, quality.learn(nothing, good))[0].count() == 0


def test_order_decides():
    x = np.array([[0.0], [1.0], [2.0], [9.0]] * 12)
    bad = np.array([False, False, False, True] * 12)
    rules = quality.learn_rules(x, bad, ["symbol_ratio"])
    assert [str(c) for r in rules.rules for c in r] == ["symbol_ratio >= 5.5"]


def _best_by_trying_all(x, bad, stats):
    """Largest FOIL gain of one condition over every cut between two values."""
    p0, n0, best = bad.sum(), len(bad), 0.0
    for j in range(len(stats)):
        values = np.unique(x[:, j])
        for cut in (values[:-1] + values[1:]) / 2:
            for hit in (x[:, j] >= cut, x[:, j] < cut):
                p, n = (bad & hit).sum(), hit.sum()
                if p >= quality.MIN_COVER:
                    best = max(best, p * (np.log2(p / n) - np.log2(p0 / n0)))
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_first_condition_is_the_best(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (240, 3)).astype(float)
    bad = (x[:, 1] >= 8) & (rng.random(240) < 0.9)
    stats = ["symbol_ratio", "upper_ratio", "digit_ratio"]
    rule = quality._grow(x, bad, {s: i for i, s in enumerate(stats)})
    hit = rule[0].holds(x, {s: i for i, s in enumerate(stats)})
    p, n = (bad & hit).sum(), hit.sum()
    gain = p * (np.log2(p / n) - np.log2(bad.sum() / len(bad)))
    assert gain >= 0.999 * _best_by_trying_all(x, bad, stats)


def test_as_many_rules_as_pay():
    """Twenty kinds of bad rows, each told by a range of its own; and none from noise."""
    rows, bad = [], []
    for kind in range(20):
        for i in range(60):
            rows.append([kind * 10 + 5 if i % 2 else kind * 10 + 1])
            bad.append(bool(i % 2))
    rules = quality.learn_rules(np.array(rows, float), np.array(bad), ["mean_word"])
    hit = np.zeros(len(rows), bool)
    for rule in rules.rules:
        hit |= quality._holds(list(rule), np.array(rows, float), {"mean_word": 0})
    assert len(rules.rules) > 12 and not (hit & ~np.array(bad)).any() and hit.sum() > 0.9 * sum(bad)
    rng = np.random.default_rng(1)
    noise = quality.learn_rules(rng.normal(size=(600, 2)), rng.random(600) < 0.5, ["symbol_ratio", "mean_word"])
    assert len(noise.rules) <= 1


def test_sample_is_the_smallest_hashes(spark):
    rows = spark.range(5000).selectExpr("id doc_id", "1 quality")
    got = quality._smallest_hashes(rows, 5000, 100)
    want = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(100)
    assert sorted(got.collect()) == sorted(want.collect())
    assert "Filter" in got._jdf.queryExecution().optimizedPlan().toString()
