import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from adjudica.functions import cleanse
from adjudica.functions.money import avg_money, cents, divide_half_up, from_units, scaled_ratio


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [row[0] for row in df.orderBy("i").select(build("c")).collect()]


def test_missing_texts_become_null_and_others_stay(spark):
    assert column(spark, ["NA", " nan ", "", None, "N/A", "3600", " x "], cleanse.null_tokens) == [
        None, None, None, None, None, "3600", " x ",
    ]


def test_dates_never_raise(spark):
    got = column(spark, ["2009-01-05", " 2009-01-05 ", "2009-13-40", "NA", "", None, "2009", "2009-02-30", "2009-01-05 00:00:00", "2009-1-5", "2009-01-05T10:30:00"], cleanse.lenient_date)
    assert got == [datetime.date(2009, 1, 5)] * 2 + [None] * 6 + [datetime.date(2009, 1, 5)] * 3


def test_what_reading_would_lose(spark):
    assert column(spark, ["2009-01-05", "NA", None, "5 Jan", "2009-13-40"], cleanse.unreadable_date) == [False, False, False, True, True]
    texts = ["12.5", "NA", None, "abc", "1,200.50", "123456789012", "9999999999.99", "-0.004"]
    assert column(spark, texts, cleanse.unreadable_amount) == [False, False, False, True, True, False, False, False]
    assert column(spark, texts, cleanse.amount_too_large) == [False] * 5 + [True, False, False]


def test_flags_renal_and_labels(spark):
    assert column(spark, ["1", " 1", "2", "NA", None, "x"], cleanse.decode_flag) == [True, True, False, False, False, False]
    assert column(spark, ["Y", "y", "1", "true", "0", None], cleanse.decode_renal) == [True, True, True, True, False, False]
    assert column(spark, ["Yes", " Yes ", "No", "Maybe", None], cleanse.decode_label) == [True, True, False, None, None]


def test_amounts_default_to_zero(spark):
    assert column(spark, ["12.5", "NA", None, "abc", "-3"], cleanse.money_or_zero) == [
        Decimal("12.50"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), Decimal("-3.00"),
    ]


def test_stay_is_never_negative_or_null(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (DATE'2009-01-01', DATE'2009-01-05'), (DATE'2009-01-05', DATE'2009-01-01'),"
        " (NULL, DATE'2009-01-01'), (DATE'2009-01-01', NULL) t(a, d)"
    )
    assert [r[0] for r in df.select(cleanse.length_of_stay("a", "d")).collect()] == [4, 0, 0, 0]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.sql("SELECT * FROM VALUES (5L, 2L), (-5L, 2L), (7L, 3L), (1L, 3L), (0L, 4L), (3L, 0L) t(s, n)")
    assert [r[0] for r in df.select(divide_half_up(F.col("s"), F.col("n"))).collect()] == [3, -3, 2, 0, 0, None]
    one = spark.sql("SELECT 789499L AS s, 2L AS n, 1L AS a, 8L AS b, CAST(12.34 AS DECIMAL(12,2)) AS d")
    row = one.select(
        avg_money(F.col("s"), F.col("n")), from_units(scaled_ratio(F.col("a"), F.col("b"), 2)), cents(F.col("d"))
    ).first()
    assert (row[0], row[1], row[2]) == (Decimal("3947.50"), Decimal("0.13"), 1234)
