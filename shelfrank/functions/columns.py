"""Scalar column helpers. All are built-in Spark expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# Epoch values at or above 1e11 are milliseconds (the server writes ms, the
# loader and the month function take seconds).
MS_THRESHOLD = 100_000_000_000
# Scores are ranked on this many decimals, with ties broken by id, so that a
# ranking does not depend on floating-point summation order.
RANK_DIGITS = 9
_TWO_32 = 4294967296
_TWO_31 = 2147483648


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Normalise an epoch value to seconds: values >= 1e11 are taken as ms."""
    c = as_col(ts).cast("long")
    return F.when(c >= F.lit(MS_THRESHOLD), F.floor(c / F.lit(1000))).otherwise(c).cast("long")


def year_month(ts) -> Column:
    """Epoch seconds (or ms) -> 'yyyy-MM' in the session zone (pinned to UTC)."""
    return F.date_format(F.timestamp_seconds(epoch_seconds(ts)), "yyyy-MM")


def dot(a, b) -> Column:
    """Dot product of two numeric arrays, accumulated in double."""
    prods = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def l2norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; null (not NaN, not an error) when a norm is zero."""
    denom = l2norm(a) * l2norm(b)
    return F.when(denom > 0, dot(a, b) / denom)


def half_star(score) -> Column:
    """Raw 1..10 score -> stars: score / 2 rounded half-up to two decimals."""
    return F.round(as_col(score).cast("double") / F.lit(2.0), 2)


# Java's String.trim() strips every character <= U+0020.
_JAVA_WHITESPACE = "".join(chr(i) for i in range(0x21))


def java_trim(s) -> Column:
    """Java String.trim(): strip all characters <= U+0020 at both ends."""
    return F.trim(as_col(s), F.lit(_JAVA_WHITESPACE))


def java_string_hash(s) -> Column:
    """Java String.hashCode() of a string column, as INT.

    h = 31 * h + unit over the UTF-16 code units; code points above U+FFFF
    contribute their two surrogate units.
    """
    chars = F.filter(F.split(as_col(s), ""), lambda c: c != F.lit(""))

    def step(acc, ch):
        cp = F.ascii(ch).cast("long")
        off = cp - F.lit(0x10000)
        hi = F.lit(0xD800) + F.shiftright(off, 10)
        lo = F.lit(0xDC00) + F.pmod(off, F.lit(1024))
        one = F.pmod(acc * 31 + cp, F.lit(_TWO_32))
        two = F.pmod(F.pmod(acc * 31 + hi, F.lit(_TWO_32)) * 31 + lo, F.lit(_TWO_32))
        return F.when(cp > F.lit(0xFFFF), two).otherwise(one)

    unsigned = F.aggregate(chars, F.lit(0).cast("long"), step)
    return F.when(unsigned >= F.lit(_TWO_31), unsigned - F.lit(_TWO_32)).otherwise(unsigned).cast("int")


def pack_entry(product_id, score) -> Column:
    """Recent-queue entry 'productId:score'."""
    return F.concat_ws(":", as_col(product_id).cast("string"), as_col(score).cast("string"))


def unpack_entry(entry) -> tuple[Column, Column]:
    parts = F.split(as_col(entry), ":")
    return (
        java_trim(parts.getItem(0)).try_cast("int"),
        java_trim(parts.getItem(1)).try_cast("double"),
    )


def rank_key(score) -> Column:
    """Ranking key for descending score order (see RANK_DIGITS)."""
    return F.round(as_col(score), RANK_DIGITS)
