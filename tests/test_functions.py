"""Column functions on hand-written values, against the Python standard library."""

from __future__ import annotations

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orebed import functions as fn


def column(spark, values, expression, type="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {type}")
    return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_safe_cast(spark):
    values = ["5.0", "", " 5 ", "1e3", "x", None]
    assert column(spark, values, fn.safe_cast("x", "integer")) == [None, None, 5, None, None, None]
    numeric = column(spark, ["5.0", "", "1e3", "bad"], fn.safe_cast("x", "numeric"))
    assert [None if v is None else float(v) for v in numeric] == [5.0, None, 1000.0, None]


def test_dates(spark):
    values = ["2024-01-02", "", "bad", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05.123456"]
    found = column(spark, values, F.date_format(fn.coerce_timestamp("x"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert found == [
        "2024-01-02 00:00:00.000000",
        None,
        None,
        "2024-01-02 03:04:05.000000",
        "2024-01-02 03:04:05.123456",
    ]


def test_format_date(spark):
    values = [
        "2024-01-05",
        "2024-01-05 10:11:12",
        "2024-01-05T10:11:12.5",
        "2024-01-05T10:11:12Z",
        "2024-01-05T10:11:12.000001+02:00",
        "2024-01-05 10:11",
        "2024-01-05 10",
        "bad",
        "2024-13-01",
        None,
    ]

    def expected(text):
        try:
            return datetime.datetime.fromisoformat(text).isoformat()
        except (TypeError, ValueError):
            return None

    assert column(spark, values, fn.format_date("x")) == [expected(v) for v in values]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00")), min_size=30, max_size=60))
def test_text_functions_equal_python(spark, values):
    assert column(spark, values, fn.strip("x")) == [v.strip() for v in values]
    # Letters newer than the Unicode tables of the JVM are unknown to it: stay with old blocks.
    known = [v for v in values if all(ord(c) < 0x500 for c in v)]
    cleaned = ["".join(c for c in v if c.isalnum() or c.isspace()) for v in known]
    if known:
        assert column(spark, known, fn.clean_string("x")) == cleaned


def test_money(spark):
    cents = column(spark, ["12345", "12345.5", "-5", "x"], fn.cents_to_dollars("x"))
    assert [None if c is None else str(c) for c in cents] == ["123.45", "123.46", "-0.05", None]
    assert str(column(spark, ["12345"], fn.cents_to_dollars("x", 1))[0]) == "123.5"


def test_masks(spark):
    values = ["abcdefgh", "ab", None]
    assert column(spark, values, fn.mask_pii("x")) == [
        "abcd****-PII-MASKED-****",
        "ab****-PII-MASKED-****",
        None,
    ]
    assert column(spark, values, fn.mask_pii("x", "none")) == values
    assert column(spark, values, fn.mask_pii("x", "null")) == [None] * 3
    hashed = column(spark, values, fn.mask_pii("x", "sha256"))
    assert hashed[2] is None and len(set(hashed)) == 3
    assert column(spark, [7], fn.mask_pii("x", data_type="int"), "int") == [None]
    with pytest.raises(ValueError):
        fn.mask_pii("x", "rot13")


def test_sql_functions(spark):
    names = fn.register_sql_functions(spark)
    assert "mask_pii" in names
    row = spark.sql("SELECT mask_pii('abcdefgh') m, safe_numeric('x') n, safe_timestamp('2024-01-01') t").first()
    assert row.m.startswith("abcd*") and row.n is None and row.t.year == 2024
