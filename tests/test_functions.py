from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from qualitypipe import fixed_values as fixed
from qualitypipe.functions import columns as fn


def _values(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", make(F.col("t")).alias("x")).orderBy("i").collect()]


def test_text_to_int_truncates(spark):
    texts = ["7.9", " 7 ", "x", "-3.5", "3000000000", None, "", ".5", "-.5", ".", "+", "5.", "1e3"]
    assert _values(spark, texts, fn.text_to_int) == [7, 7, None, -3, None, None, None, 0, 0, 0, None, 5, None]


def test_text_to_int_range(spark):
    texts = ["2147483647", "2147483648", "-2147483648", "-2147483649", "0000000000000012", "99999999999"]
    assert _values(spark, texts, fn.text_to_int) == [2147483647, None, -2147483648, None, 12, None]


def test_text_to_boolean(spark):
    texts = ["yes", "T", " 1 ", "true", "no", "F", "0", "maybe", "", None, "truee"]
    assert _values(spark, texts, fn.text_to_boolean) == [True] * 4 + [False] * 3 + [None] * 4


@pytest.mark.parametrize(
    ("target", "kind"), [("integer", "int"), ("double", "double"), ("boolean", "boolean"), ("date", "date")]
)
def test_text_casts_equal_casts_that_never_fail(spark, target, kind):
    """With ANSI mode off a plain cast gives NULL for bad text: the same values must come out."""
    chooser = random.Random(11)
    alphabet = "0123456789..+-eEdfxp \tinfaNTtrueysno1"
    texts = {"".join(chooser.choices(alphabet, k=chooser.randint(0, 6))) for _ in range(4000)}
    texts |= {f"{chooser.randint(-(10**10), 10**10)}{chooser.choice(['', '.', '.7', ' '])}" for _ in range(500)}
    texts |= {"NaN", "nan", "-Infinity", "inf", "0x1p3", "1_0", "TRUE", " Yes ", "2023-02-30", "2023-02-28\n"}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "t string")
    lenient = fn.lenient_cast(F.col("t"), df.schema["t"].dataType, target)
    ours = [str(r.x) for r in df.select(lenient.cast("string").alias("x")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = [str(r.x) for r in df.select(F.col("t").cast(kind).cast("string").alias("x")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert ours == plain


def test_double_to_int_truncates_and_overflow_is_null(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (3e9,), (None,)], "d double")
    cast = fn.lenient_cast(F.col("d"), df.schema["d"].dataType, "integer")
    assert [r.x for r in df.select(cast.alias("x")).collect()] == [2, -2, None, None]


def test_parse_date_follows_the_format(spark):
    texts = ["2023-01-15", "invalid-date", "2023-99-99", "2023-02-29", "2023-1-5", " 2023-01-15", None]
    texts += ["2023-01-15\n", "-2023-01-15x", "12345-01-01"]
    assert _values(spark, texts, fn.parse_date) == [date(2023, 1, 15)] + [None] * 9
    other = _values(spark, ["15/01/2023", "2023-01-15"], lambda c: fn.parse_date(c, "dd/MM/yyyy"))
    assert other == [date(2023, 1, 15), None]


def test_parse_date_equals_the_formatter(spark):
    years = ["2023", "0000", "0001", "+2023", "-2023", "12345", "+12345", "023", "1582"]
    texts = [f"{y}-{m}-{d}" for y in years for m in ("01", "02", "13", "1") for d in ("05", "29", "31", "5")]
    formatter = _values(spark, texts, lambda c: F.try_to_date(c, fixed.DATE_FORMAT).cast("string"))
    assert _values(spark, texts, lambda c: fn.parse_date(c).cast("string")) == formatter


def test_coordinates(spark):
    texts = ["[4.85,45.76]", "x [ 1 , 2 ] y [3,4]", "[5.25]", "n/a", "[]", "[a,b]", "4.85,45.76", None]
    longitude = _values(spark, texts, lambda c: fn.coordinates(c)[0])
    latitude = _values(spark, texts, lambda c: fn.coordinates(c)[1])
    assert longitude == [4.85, 1.0, 5.25, None, None, None, None, None]
    assert latitude == [45.76, 2.0, None, None, None, None, None, None]


def test_city(spark):
    texts = ["1 rue X 75001 Paris", "42000 Saint-Étienne", "75001 Évry", "no code", "01440 La Motte", None]
    assert _values(spark, texts, fn.city) == ["Paris", "Saint-", "", "", "La", None]
    unicode_words = _values(spark, texts[:2], lambda c: fn.city(c, "(?U)" + fixed.CITY_PATTERN))
    assert unicode_words == ["Paris", "Saint-Étienne"]


def test_first_true(spark):
    df = spark.createDataFrame(
        [(True, True), (False, True), (None, True), (None, None), (False, False)], "a boolean, b boolean"
    )
    label = fn.first_true({"a": "A", "b": "B"}, "none")
    assert [r.x for r in df.select(label.alias("x")).collect()] == ["A", "B", "B", "none", "none"]


def test_bucketize(spark):
    df = spark.createDataFrame([(49,), (50,), (149,), (150,), (None,)], "p int")
    label = fn.bucketize(F.col("p"), fixed.POWER_BOUNDS, "High", "Unknown")
    labels = [r.x for r in df.select(label.alias("x")).collect()]
    assert labels == ["Low", "Medium", "Medium", "High", "Unknown"]


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c`d"])
    assert df.select(fn.col_named("a.b"), fn.col_named("c`d")).first() == (1, 2)
