import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrank.llm import fingerprints as fp

from .conftest import ROWS, prose


def brute(rows):
    """Pairs of each row with the next by descending id, nulls last, then text."""
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] or "")
    order = sorted(((d, t or "") for d, t in rows), key=key)
    out = []
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + following[:half]
        a, b = fp.fingerprint(t.encode()), fp.fingerprint(changed.encode())
        near = fp.likeness(a, b), fp.likeness(a, fp.fingerprint(following.encode()))
        out.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b, *near))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("parts", [1, 4])
def test_next_document(docs, parts):
    assert ordered(fp.with_next(docs, parts).collect()) == ordered(brute(ROWS))


def test_one_row_is_its_own_next(spark):
    row = fp.with_next(spark.createDataFrame([(7, "abcd")], "doc_id long, text string"), 3).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0


def test_empty_table(nothing):
    assert fp.with_next(nothing, 3).collect() == []


def test_likeness_follows_the_edit():
    a, b = prose(1, 600), prose(2, 600)
    whole, half = fp.fingerprint(a.encode()), fp.fingerprint((a[:1800] + b[:1800]).encode())
    other = fp.fingerprint("Ganz andere Wörter, etwas länger als zuvor, und so weiter.".encode() * 40)
    assert fp.likeness(whole, whole) == 1.0
    assert 1 > fp.likeness(whole, half) > fp.likeness(whole, other) >= 0
    assert fp.fingerprint(b"") == fp.fingerprint(b"") and fp.likeness(fp.fingerprint(b""), whole) < 0.5


def plain_digest(raw):
    """The digest, triplet by triplet."""
    mask = 0xFFFFFFFF
    count = [0] * 256
    texts = [list(raw)]
    if 0 < len(raw) < 8:
        texts += [[*raw, 256], [*raw, 256, 256]]
    for b in texts:
        for salt, last in ((0, 2), (1, 3)):
            for i in range(len(b) - last):
                h = (b[i] + salt * 257) * 0x9E3779B1 & mask
                h ^= b[i + 1] * 0x85EBCA77 + (h >> 15) & mask
                h = (h ^ (b[i + last] * 0xC2B2AE3D & mask)) * 0x9E3779B1 & mask
                count[h >> 24] += 1
    q1, q2, q3 = (sorted(count)[i] for i in (63, 127, 191))
    bits = "".join(f"{(c > q1) + (c > q2) + (c > q3):02b}" for c in count)
    head = [min(255, round(math.log(len(raw) + 1, 1.2))), 16 * q1 // (q3 + 1) << 4 | 16 * q2 // (q3 + 1)]
    return bytes(head).hex() + f"{int(bits, 2):0128x}"


@given(st.binary(max_size=2000) | st.text(max_size=12).map(str.encode))
@settings(max_examples=80, deadline=None)
def test_digest_equals_plain_version(raw):
    assert fp.fingerprint(raw) == plain_digest(raw)


@pytest.mark.parametrize(
    "a,b", [("ab", "zq"), ("a", ""), ("a", "b"), ("hello", "world"), ("abc", "xyz"), ("one two", "fünf sechs"), ("12:30", "noon")]
)
def test_unlike_short_texts(a, b):
    x, y = (fp.fingerprint(t.encode()) for t in (a, b))
    assert fp.likeness(x, y) == fp.likeness(y, x) < 0.5 and fp.likeness(x, x) == 1.0


def test_like_short_texts():
    like = lambda a, b: fp.likeness(*(fp.fingerprint(t.encode()) for t in (a, b)))
    assert like("a somewhat longer line of text", "a somewhat longer line of texts") > 0.7
    assert like("hello there", "hello theme") > like("hello there", "nothing else")
