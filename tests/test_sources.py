
from conftest import SF_SMALL, rows

from shelfrank.session import scratch_path
from shelfrank.sources import adapters, tables, text


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_f10_product_lines(spark):
    good, bad = text.parse_product_lines(
        lines(
            spark,
            [
                "3982^Toy, \"red\"^1057,439^B009EJN4T2^img/1.jpg^a|b|c^t1|t2",
                " 7 ^ six fields ^x^y^img/7.jpg^a|b",
                "8^empty tags^x^y^img/8.jpg^a|b^",
                "abc^bad id^x^y^img^a^t",
                "9^too few^x",
            ],
        )
    )
    assert rows(good) == [
        (7, "six fields", "img/7.jpg", "a|b", None),
        (8, "empty tags", "img/8.jpg", "a|b", None),
        (3982, 'Toy, "red"', "img/1.jpg", "a|b|c", "t1|t2"),
    ]
    assert rows(bad) == [("9^too few^x",), ("abc^bad id^x^y^img^a^t",)]


def test_rating_lines(spark):
    good, bad = text.parse_rating_lines(lines(spark, ["1,2,4.5,1260759144", "x,2,1,1", "1,2,3"]))
    assert rows(good) == [(1, 2, 4.5, 1260759144)]
    assert len(rows(bad)) == 2


def test_f12_log_line(spark):
    out, bad = text.parse_log_lines(
        lines(
            spark,
            [
                "2019-12-09 10:00:00 INFO [exec-1] api - PRODUCT_RATING_PREFIX:-5|12|3.5|1575900000",
                "2019-12-09 10:00:01 INFO [exec-1] api - something else",
                "x PRODUCT_RATING_PREFIX:99999999999|12|3.5|1575900000",
                "x PRODUCT_RATING_PREFIX:5|12|3.0.1|1575900000",
                "x PRODUCT_RATING_PREFIX:5|12|3.5",
                "x PRODUCT_RATING_PREFIX:6|12|3.5|1575900000123",
            ],
        )
    )
    assert rows(out) == [(-5, 12, 3.5, 1575900000), (6, 12, 3.5, 1575900000)]
    assert len(rows(bad)) == 3
    msgs = text.log_lines_to_messages(
        lines(spark, ["x PRODUCT_RATING_PREFIX:-5|12|3.5|1575900000"])
    )
    assert rows(msgs) == [("-5|12|3.5|1575900000",)]


def test_event_messages_bad_rows_to_side_table(spark):
    df = spark.createDataFrame([(1, "4|12|3.5|100"), (2, "4|x|3.5|100"), (3, "4|12|3.5")], "event_id long, value string")
    good, bad = text.parse_event_messages(df)
    assert rows(good) == [(1, 4, 12, 3.5, 100)]
    assert rows(bad, "event_id") == [(2,), (3,)]


def test_adapters_shapes(spark):
    assert adapters.ratings(spark, SF_SMALL).columns == ["userId", "productId", "score", "timestamp"]
    assert adapters.products(spark, SF_SMALL).columns == ["productId", "name", "imageUrl", "categories", "tags"]
    ev = adapters.rating_events(spark, SF_SMALL)
    assert ev.where("score < 0.5 or score > 5.0").count() == 0


def test_table_roundtrip_clustered(spark):
    df = adapters.ratings(spark, SF_SMALL)
    path = scratch_path(spark, "t")
    tables.write_table(df, path, key="userId", partitions=4)
    back = tables.read_table(spark, path)
    assert rows(back) == rows(df)
    assert len(back.inputFiles()) <= 4


def test_delimited_fields_trimmed_like_java(spark):
    good, bad = text.parse_rating_lines(lines(spark, ["\x01 1\x1f,\t2 ,3.5\x00,4", "1,2,3.5,4,extra"]))
    assert rows(good) == [(1, 2, 3.5, 4), (1, 2, 3.5, 4)]
    assert rows(bad) == []
