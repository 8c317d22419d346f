from pyspark.sql import functions as F

from shelfrank.functions import cosine, epoch_seconds, half_star, java_string_hash, java_trim, year_month


def java_hash(s: str) -> int:
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (31 * h + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_f9_month_seconds_and_millis(spark):
    df = spark.createDataFrame([(1260759144,), (1260759144000,)], "ts long")
    out = [r[0] for r in df.select(year_month("ts")).collect()]
    assert out == ["2009-12", "2009-12"]
    secs = [r[0] for r in df.select(epoch_seconds("ts")).collect()]
    assert secs == [1260759144, 1260759144]


def test_f11_half_star(spark):
    df = spark.createDataFrame([(1,), (7,), (10,)], "raw int")
    assert [r[0] for r in df.select(half_star("raw")).collect()] == [0.5, 3.5, 5.0]


def test_f13_java_hash(spark):
    names = ["abc", "", "hello world", "Customer#000000001", "naïve", "a\U0001F600b"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = [r[0] for r in df.select(java_string_hash("s")).collect()]
    assert got[:3] == [96354, 0, 1794106052]
    assert got == [java_hash(n) for n in names]


def test_java_trim(spark):
    df = spark.createDataFrame([("\t x y \n",)], "s string")
    assert df.select(java_trim("s")).first()[0] == "x y"


def test_cosine_zero_norm_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [2.0, 0.0])], "a array<double>, b array<double>")
    out = [r[0] for r in df.select(cosine("a", "b")).collect()]
    assert out[0] is None and abs(out[1] - 1.0) < 1e-12


def test_rank_key_is_rounded(spark):
    from shelfrank.functions import rank_key

    df = spark.createDataFrame([(0.30000000000000004,), (0.3,)], "x double")
    vals = {r[0] for r in df.select(rank_key("x")).collect()}
    assert vals == {0.3}
    assert df.select(F.round("x", 9)).count() == 2
