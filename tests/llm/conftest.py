import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORDS = "The of AND thing water river stone über 'tis naïve 12 x1, end. café ça ¡no! to in".split()


def prose(seed, n):
    import random

    dice = random.Random(seed)
    return " ".join(dice.choice(WORDS) + dice.choice(["", "", "s", "ing", str(dice.randint(0, 9))]) for _ in range(n))


BASE = prose(1, 120)
#: Ordinary, null, empty, blank, long, equal and nearly equal texts, repeated rows and ids.
ROWS = [
    (1, BASE),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, prose(2, 9000)),
    (6, BASE),
    (7, BASE.replace("water", "fire", 1)),
    (8, "one two"),
    (9, "One TWO"),
    (10, "日本語 \U0001d11e ▁mark\u00a0x"),
    (11, "..."),
    (12, prose(3, 40)),
    (12, prose(3, 40)),
    (13, prose(4, 60) + "\n" + prose(4, 60)),
    (None, "no id here, only text"),
    (2**40, "x" * 5000),
]


@pytest.fixture(scope="session")
def docs(spark):
    """ROWS with a language, and further columns whose names operators use."""
    rows = [(d, t, "en" if i % 2 else "de", 5, "mine", True) for i, (d, t) in enumerate(ROWS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, score int, N_words string, kept boolean"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
