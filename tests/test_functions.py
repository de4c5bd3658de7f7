from pyspark.sql import functions as F

from lodgeflow.functions import (as_compared, as_decimal, as_number, percent_of, clean_coordinate, digits_only, parse_date,
                                 percent, strip_special, title_text)


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_strip_then_title(spark):
    assert one(spark, lambda c: title_text(strip_special(c)), " GRAND!! hotel. ") == "Grand Hotel"


def test_strip_keeps_tabs_and_inner_spaces(spark):
    assert one(spark, strip_special, "\ta,b  c ") == "\tab  c"


def test_title_words_are_space_delimited(spark):
    assert one(spark, title_text, "o'neil-smith  de la") == "O'neil-smith  De La"


def test_digits_only(spark):
    assert one(spark, digits_only, "+90 (212) 555-01") == "9021255501"


def test_coordinates(spark):
    f = lambda c: clean_coordinate(c, -90, 90)
    assert one(spark, f, "0") is None
    assert one(spark, f, "91") is None
    assert one(spark, f, "abc") is None
    assert one(spark, f, None) is None
    assert one(spark, f, "41.12345678") == 41.123457
    assert one(spark, f, "-90") == -90.0


def test_parse_date_bad_text_is_null(spark):
    assert one(spark, parse_date, "31/12/2024") is None
    assert str(one(spark, parse_date, "2024-12-31")) == "2024-12-31"
    assert one(spark, parse_date, "") is None


def test_text_as_a_number_and_as_compared_with_whole_numbers(spark):
    want = {"4.5": (4.5, 4), "5.9": (5.9, 5), "0.9": (0.9, 0), "x": (None, None), None: (None, None),
            "1e1": (10.0, None), "": (None, None), " 3 ": (3.0, 3), "\t+7.": (7.0, 7), ".5": (0.5, 0), "-0.5": (-0.5, 0),
            "-.5": (-0.5, 0), "-3.9": (-3.9, -3), "-": (None, None), "4.x": (None, None), "1.2.3": (None, None),
            "99999999999": (99999999999.0, None), "2147483647.9": (2147483647.9, 2147483647), "007": (7.0, 7)}
    df = spark.createDataFrame([(v,) for v in want], "v string")
    got = df.select(as_number("v").alias("d"), as_compared("v").alias("t")).collect()
    assert [tuple(r) for r in got] == list(want.values())


def test_columns_that_are_no_text_are_compared_as_they_are(spark):
    df = spark.createDataFrame([(0.9, 2)], "d double, i int")
    assert df.select(as_compared("d"), as_compared("i")).first()[:] == (0.9, 2.0)


def test_percent_of_is_percent(spark):
    pairs = [(p, t) for t in (0, 1, 3, 7, 32, 96, 160, 800, 4000, 20000) for p in range(0, t + 1, max(1, t // 40))]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(pairs)], "i int, p long, t long")
    got = [r[0] for r in df.orderBy("i").select(percent("p", "t")).collect()]
    assert got == [percent_of(p, t) for p, t in pairs]
    assert percent_of(1, 32) == 3.12 and percent_of(3, 32) == 9.38


def test_decimal_rounds_half_up(spark):
    assert str(one(spark, as_decimal, "2.675")) == "2.68"
    assert one(spark, as_decimal, "abc") is None


def test_percent_exact_half_up_and_zero(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 0), (1, 200000)], "p long, t long")
    got = [r[0] for r in df.select(percent("p", "t")).collect()]
    assert got == [12.5, 33.33, 66.67, None, 0.0]
    assert df.limit(1).select(percent(F.lit(1), F.lit(32)), percent(F.lit(3), F.lit(32))).first()[:] == (3.12, 9.38)
    zero = df.where("t = 0").select(percent("p", "t", zero_total=0.0)).first()[0]
    assert zero == 0.0
