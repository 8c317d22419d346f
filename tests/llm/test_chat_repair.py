import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from shelfrank.llm import chat_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def _after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:32].encode(), hashlib.md5(r[2].encode()).hexdigest())
    return sorted(out, key=order)


def _plain(rows):
    """The result for one conversation, by a table over every suffix and state."""
    rows = _after_damage(rows)
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    seen, faults = set(), []
    for _, role, text in rows:
        said = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    go = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {s: {0: (0, "", []), 3: (0, "", [])}.get(s, (10**9, "", [])) for s in range(4)}

    def inserted(best):
        for _ in range(4):
            for (s, c), after in go.items():
                if c != "s":
                    cost, audit, kept = best[after]
                    name = {"u": "user", "a": "assistant"}[c]
                    best[s] = min(best[s], (cost + 5, "I" + audit, [f"{name}:", *kept]), key=lambda x: x[:2])
        return best

    best = inserted(best)
    for (_, role, text), fault in list(zip(rows, faults))[::-1]:
        now = {}
        for s in range(4):
            cost, audit, kept = best[s]
            options = [(cost + 2, "D" + audit, kept)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                after = go.get((s, role[:1]))
                if after is not None:
                    cost, audit, kept = best[after]
                    options.append((cost + more, "K" + audit, [f"{role}:{text}", *kept]))
                for c, name in (("u", "user"), ("a", "assistant")):
                    after = go.get((s, c))
                    if after is not None:
                        cost, audit, kept = best[after]
                        options.append((cost + more + 1, "R" + audit, [f"{name}:{text}", *kept]))
            now[s] = min(options, key=lambda x: x[:2])
        best = inserted(now)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, kept = best[0]
    sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha)


def _want(rows):
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append((conv, *rest))
    return sorted(((c, *_plain(r)) for c, r in by.items()), key=str)


def _got(df):
    return sorted((tuple(r) for r in chat_repair.repair(df).collect()), key=str)


@cache
def _conversations():
    dice = random.Random(5)
    rows = []
    texts = ["Yes.", "No!", "well", "", " \t", "Is it?", "Yes. ", "so...", "é."] + [f"word {i}." for i in range(30)]
    for conv in range(150):
        turn = 0
        for _ in range(dice.randint(1, 14)):
            turn += dice.choice([0, 1, 1, 1, 2])
            role = dice.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "umpire"])
            rows.append((dice.choice([conv, conv, conv, None if conv == 7 else conv]), dice.choice([turn] * 9 + [None]), role, dice.choice([*texts, None])))
    return rows


def test_equal_to_plain_table(spark):
    rows = _conversations()
    assert _got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == _want(rows)


def test_one_conversation_over_all_partitions(spark, monkeypatch):
    dice = random.Random(6)
    rows = []
    for i in range(3000):
        role = ["user", "assistant"][i % 2] if dice.random() < 0.8 else dice.choice(["user", "assistant", "system", "x"])
        rows.append((1, i // 2 if i % 7 else i // 2 + 1, role, f"say {i if i % 5 else 0}{dice.choice(['.', '!', '', '.'])}"))
    rows += [(c, t, "user", "Hi.") for c in (0, 2) for t in range(3)]
    monkeypatch.setattr(chat_repair, "default_parts", lambda df: 23)
    assert _got(spark.createDataFrame(rows, SCHEMA)) == _want(rows)


def test_copies_meet_as_one_row(spark):
    rows = [(1, 0, "user", "Hello.")] * 4000 + [(1, 1, "assistant", "Yes.")] * 3 + [(1, None, "user", "Hello.")] * 5
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(df) == _want(rows)
    assert chat_repair._rows(df).count() == 3


def test_all_costs_by_powers():
    """Powers give what steps one by one give, for every symbol and length."""
    powers = chat_repair.Powers()
    for symbol in (chat_repair.GONE, *(3 * r + f for r in range(4) for f in (0, 1))):
        costs = chat_repair.END
        for n in range(1, 40):
            costs = chat_repair._ahead(powers[symbol, 0], costs)
            assert powers.over(symbol, n, chat_repair.END) == costs


def test_long_run_in_little_memory():
    powers = chat_repair.Powers()
    runs = [(3 * chat_repair.USER, 100_001)]
    costs = powers.before(runs, chat_repair.END)
    letters = "".join(c for c, _ in powers.letters(0, *runs[0], costs[1]))
    assert len(letters) == 100_001 and costs[0][0] == 50_000 + 2 and letters.count("D") == 1


def test_empty_clashing_and_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat_repair.repair(empty).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("AUDIT", "w", "part", "key", "first", "_c", "cost"):
        df = df.withColumn(name, F.lit("x"))
    assert _got(df) == _want(rows)


@pytest.mark.parametrize("text", ["a" * 2_000_000 + ".", "." * 200_000 + "x", " " * 300_000])
def test_long_texts(spark, text):
    rows = [(1, 0, "user", text), (1, 1, "assistant", "Yes."), (1, 2, "user", "b."), (1, 3, "assistant", "c.")]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == _want(rows)
