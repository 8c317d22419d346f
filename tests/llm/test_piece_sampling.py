import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrank.llm import piece_sampling as ps

from .conftest import ROWS


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary(model):
    return ps.Vocabulary(model)


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60) | st.text(" ▁ab\n\t\U0001d11e\x00é", max_size=40))
def test_decoding_is_lossless(vocabulary, text):
    (ids,) = ps.encode(vocabulary, [text.encode()], [1])
    assert vocabulary.decode(ids.tolist()) == text.encode()


def test_draws_follow_the_path_weights(vocabulary):
    unit, of = "▁then", {b: i for i, b in enumerate(vocabulary.bytes) if b and i > 258}

    def paths(rest):
        if not rest:
            yield ()
        for n in range(1, len(rest) + 1):
            if rest[:n] in of:
                for more in paths(rest[n:]):
                    yield (of[rest[:n]], *more)

    every = list(paths(b" then"))
    weight = np.exp([vocabulary.weight[list(p)].sum() for p in every])
    weight /= weight.sum()
    n = 200_000
    key = np.random.default_rng(1).integers(0, 2**63, n).astype(np.uint64)
    pieces, held = ps.Lattices(vocabulary, ["▁other", unit]).sample(np.ones(n, np.int64), key)
    seen = Counter(tuple(x.tolist()) for x in np.split(pieces, np.cumsum(held)[:-1]))
    assert set(seen) <= set(every)
    for path, p in zip(every, weight):
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p / n) + 1e-4


def test_keys_seed_the_draws(vocabulary):
    text = b"reproducible segmentations of many different words " * 20
    a, b, c = ps.encode(vocabulary, [text, text, text], [1, 2, 1])
    (alone,) = ps.encode(vocabulary, [text], [1])
    assert a.tolist() == c.tolist() == alone.tolist() != b.tolist()
    assert ps.encode(vocabulary, [text], [1], seed=21)[0].tolist() != a.tolist()


def test_rows(docs, nothing, model):
    rows, names = ps.segment(docs, model)
    found = rows.collect()
    assert len(found) == len(ROWS) and all(r[names[-1]] for r in found)
    again = ps.segment(docs.repartition(7), model)[0].collect()
    key = lambda r: (r["doc_id"], r["text"], tuple(r[names[0]]))
    assert sorted(map(key, found), key=repr) == sorted(map(key, again), key=repr)
    assert all(r[names[1]] == 0 for r in found if not r["text"])
    assert ps.segment(nothing, model)[0].collect() == []


@pytest.mark.parametrize("block", [40, 333, 5000])
def test_long_units_in_blocks_equal_lattices(vocabulary, block):
    dice = random.Random(3)
    for alphabet in ("ab", "theinorst", "日本語のé\U0001d11e\udc81 x"):
        unit = "▁" + "".join(dice.choice(alphabet) for _ in range(3000)).replace(" ", "")
        for key in (1, 2**63 + 5):
            got = ps.long_path(vocabulary, unit, key, block)
            want, _ = ps.Lattices(vocabulary, [unit]).sample(np.zeros(1, np.int64), np.array([key], np.uint64))
            assert got.tolist() == want.tolist()


def test_held_lattices_change_nothing(vocabulary, monkeypatch):
    dice = random.Random(4)
    words = ["".join(dice.choice("abcdehinorst") for _ in range(dice.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(dice.choice(words) for _ in range(200)).encode() for _ in range(12)] + [b"x" * 500]
    alone = [ps.encode(vocabulary, [t], [i])[0].tolist() for i, t in enumerate(texts)]
    for room in (0, 500, 10**6):
        monkeypatch.setattr(ps, "HELD_CHARS", room)
        monkeypatch.setattr(ps, "LONG_UNIT", 100)
        encoder, got = ps.Encoder(vocabulary), []
        for i in range(0, len(texts), 3):
            ids, offsets = encoder.encode(texts[i : i + 3], list(range(i, i + len(texts[i : i + 3]))))
            got += [x.tolist() for x in np.split(ids, offsets[1:-1])]
        assert got == alone
        assert (len(encoder.held) > 0) == (room > 0)


def test_text_without_spaces(vocabulary):
    """5 MB in one unit: seconds, not hours."""
    raw = b"abcdefghij" * 500_000
    start = time.time()
    (ids,) = ps.encode(vocabulary, [raw], [1])
    assert time.time() - start < 90
    assert vocabulary.decode(ids.tolist()) == raw
