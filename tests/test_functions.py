import datetime as dt

import pytest
from pyspark.sql import functions as F

from tamiz.functions.casts import as_integer, as_number, as_timestamp, cast_to
from tamiz.functions.missing import PROFILE_TOKENS, missing
from tamiz.functions.text import header_name, key_text, literal, name_text, strip


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}").coalesce(1)


def seen(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_missing_reads_blank_text_and_tokens_as_no_value(spark):
    df = column(spark, [None, "", " \t", " NULL ", "none", "NaT", "0", "Null", "n/a"])
    assert seen(df, missing(df, "x")) == [True, True, True, True, True, True, False, False, False]
    assert seen(df, missing(df, "x", PROFILE_TOKENS)) == [True, True, True, True, False, False, False, False, False]


def test_missing_on_typed_columns(spark):
    df = column(spark, [1.0, float("nan"), None], "double")
    assert seen(df, missing(df, "x")) == [False, True, True]
    df = column(spark, [1, None], "int")
    assert seen(df, missing(df, "x")) == [False, True]


@pytest.mark.parametrize(
    ("text", "number", "whole"),
    [
        ("12", 12.0, 12),
        (" 12.0 ", 12.0, 12),
        ("1e3", 1000.0, 1000),
        ("1.5", 1.5, None),
        ("-.5", -0.5, None),
        ("123456789012345678", 123456789012345678.0, 123456789012345678),
        ("abc", None, None),
        ("1d", None, None),
        ("0x1p3", None, None),
        ("NaN", None, None),
        ("", None, None),
        (None, None, None),
        ("1,000", None, None),
    ],
)
def test_numbers(spark, text, number, whole):
    df = column(spark, [text])
    assert seen(df, as_number(df, "x")) == [number]
    assert seen(df, as_integer(df, "x")) == [whole]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("5/3/2020", dt.datetime(2020, 3, 5)),
        ("05/03/2020 7:08:09", dt.datetime(2020, 3, 5, 7, 8, 9)),
        ("2020-3-5", dt.datetime(2020, 3, 5)),
        ("2020-03-05 01:02:03", dt.datetime(2020, 3, 5, 1, 2, 3)),
        ("2020/03/05", dt.datetime(2020, 3, 5)),
        ("31/02/2020", None),
        ("31/13/2020", None),
        ("0", None),
        ("5/3/20", None),
        (None, None),
    ],
)
def test_dates_are_day_first(spark, text, expected):
    df = column(spark, [text])
    want = expected.strftime("%Y-%m-%d %H:%M:%S") if expected else None
    assert seen(df, F.date_format(as_timestamp(df, "x"), "yyyy-MM-dd HH:mm:ss")) == [want]


def test_logical_casts(spark):
    df = column(spark, ["7", "99999999999", "x", None])
    assert seen(df, cast_to(df, "x", "integer")) == [7, None, None, None]
    assert seen(df, cast_to(df, "x", "long")) == [7, 99999999999, None, None]
    assert [str(v) for v in seen(df, cast_to(df, "x", "decimal(18,2)"))[:1]] == ["7.00"]
    with pytest.raises(ValueError, match="unknown logical type"):
        cast_to(df, "x", "complex")


def test_text_helpers(spark):
    df = column(spark, ["\t a\xa0", " 2024.0 ", "don't \\ stop"])
    assert seen(df, strip(F.col("x")))[0] == "a"
    assert seen(df, key_text(F.col("x")))[1] == "2024"
    assert seen(df, name_text(F.lit(" la   villa\tvieja ")))[0] == "LA VILLA VIEJA"
    assert seen(df, F.expr(f"x = {literal(chr(100) + 'on' + chr(39) + 't ' + chr(92) + ' stop')}"))[2] is True
    assert header_name("﻿ Tipo  de dato ") == "TIPO_DE_DATO"


def test_whole_numbers_met_by_their_digits_and_by_the_longer_way(spark):
    texts = ["+5", "-0", "007", "12.", "12.00", ".0", "1e3", "1.5e1", "15e-1", "1.5", "", ".", "+", "1d", "2147483648", "9" * 18, "9" * 19, "9" * 19 + ".0", "1e19", None]
    df = column(spark, texts)
    whole = [5, 0, 7, 12, 12, 0, 1000, 15, None, None, None, None, None, None, 2**31, 10**18 - 1, None, None, None, None]
    assert seen(df, as_integer(df, "x")) == whole
    assert seen(df, cast_to(df, "x", "integer")) == [v if v is not None and v < 2**31 else None for v in whole]
