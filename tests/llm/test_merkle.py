import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from shelfrank.llm import merkle, sha256

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def _path(levels, i):
    for level in levels[:-1]:
        yield level[i // 8 * 8 : i // 8 * 8 + 8], i % 8
        i //= 8


def _plain(rows):
    by = collections.defaultdict(list)
    for row in rows:
        text = row[4]
        if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        by[row[2]].append((row[0], _leaf(row), _leaf((*row[:4], text))))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(_tree([r[1] for r in by[lang]]))
    top = _tree([t[-1][0] for t in trees])
    out = []
    for n, lang in enumerate(langs):
        for i, (doc, leaf, changed) in enumerate(by[lang]):
            siblings, value = "", changed
            for run, slot in [*_path(trees[n], i), *_path(top, n)]:
                siblings += "".join(x for j, x in enumerate(run) if j != slot)
                value = H("".join(value if j == slot else x for j, x in enumerate(run)))
            root = top[-1][0]
            out.append((doc, leaf, trees[n][-1][0], root, H(siblings), value, value == root))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str)


def _rows(n, seed=1):
    dice = random.Random(seed)
    langs = ["en"] * 30 + ["de", "fr", "é", "", None] + [f"x{i}" for i in range(12)]
    rows = []
    for i in range(n):
        text = dice.choice([None, "", "Ab Ä", "lower only", f"Text {i}", "Z" * dice.randint(1, 300)])
        rows.append((i * 3 % (n + 7), dice.choice(["s", None, ""]), dice.choice(langs), None if i % 11 == 0 else i, text))
    return rows + [(None, "s", "en", 1, "No Id"), (None, None, None, None, None)] + rows[:5] * 3


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_equal_to_plain_tree(spark, monkeypatch, levels):
    """Chunks of one, two and four levels, so that paths pass several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "CHUNK", 8**levels)
    rows = _rows(700)
    assert _got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == _plain(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_sizes_of_one_language(spark, n):
    rows = [(i, "s", "en", i, f"T{i}") for i in range(n)]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == _plain(rows)


def test_empty_long_and_clashing(spark):
    assert _got(spark.createDataFrame([], SCHEMA)) == []
    rows = [(3, "s", "en", 1, "LONG " * 400_000), (0, "s", "en", 1, "x"), (0, "s", "en", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("LEAF", "by", "pos", "_part", "chunk", "root", "total", "id", "digest"):
        df = df.selectExpr("*", f"'x' as {name}")
    assert _got(df) == _plain(rows)


def test_states_resume_a_hash():
    """A stored state and what follows give what hashlib gives."""
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(8)]
    words = sha256.from_bytes(b"".join(digests))
    for n in range(9):
        state = sha256.start(1)
        for i in range(n):
            state = sha256.from_bytes(sha256.to_bytes(state))  # as read from a table
            state = sha256.advance(state, sha256.as_block(words[i : i + 1]))
        got = sha256.hexes(sha256.finish(state, np.array([n])))[0]
        assert got == H("".join(d.hex() for d in digests[:n]))
