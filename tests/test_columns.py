"""The cleaning rules on single columns, with hand-made edge rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import columns as C

D = date


def one(values):
    return [(v,) for v in values]


def test_date_text(evaluate):
    texts = [
        "2024-02-30", "x", None, "2024-02-29", "2024", "2024-1-5", "2024-02-29 10:00:00",
        "2024-02-29 noon", "9999-12-31", "1500-01-01", "",
    ]
    day = D(2024, 2, 29)
    expected = [None, None, None, day, None, None, day, None, None, None, None]
    assert evaluate("c string", one(texts), C.iso_date(F.col("c"))) == expected


def test_timestamp_text(evaluate):
    texts = ["2024-02-29", "2024-02-29T10:11:12.5", "later", None]
    expected = [datetime(2024, 2, 29), datetime(2024, 2, 29, 10, 11, 12, 500000), None, None]
    assert evaluate("c string", one(texts), C.iso_timestamp(F.col("c"))) == expected


def test_number_text(evaluate):
    texts = ["abc", "NaN", "-12.5", None, "12d", "1_000", " 7 ", "1e3", ".5", "Infinity", "0x10", ""]
    expected = [None, None, -12.5, None, None, None, 7.0, 1000.0, 0.5, None, None, None]
    assert evaluate("c string", one(texts), C.number(F.col("c"))) == expected
    assert evaluate("c string", one(["-12.5"]), F.abs(C.number(F.col("c")))) == [12.5]


def test_na_tokens(evaluate):
    texts = ["", "NA", "null", "None", "nan", "N/A", "0", "none", None]
    expected = [None] * 6 + ["0", "none", None]
    assert evaluate("c string", one(texts), C.na_to_null(F.col("c"))) == expected


def test_clip(evaluate):
    values = one([3.0, 10.0, 500.0, 501.0, None])
    c = F.col("c")
    assert evaluate("c double", values, C.clip(c, 10.0, 500.0)) == [10, 10, 500, 500, None]
    assert evaluate("c double", values, C.clip(c, low=10.0)) == [10, 10, 500, 501, None]


def test_clip_to_another_column(evaluate):
    rows = [(-5.0, 10.0), (200.0, 10.0), (7.0, None), (None, 10.0), (5.0, -3.0)]
    rule = C.clip_to(F.col("x"), 0.0, F.col("bound"))
    assert evaluate("x double, bound double", rows, rule) == [0, 10, 7, None, -3]


def test_whole_truncates_toward_zero(evaluate):
    values = one([3.7, -3.7, None, 1e300])
    assert evaluate("c double", values[:3], C.whole(F.col("c"), 9)) == [3, -3, 9]
    assert evaluate("c double", values, C.whole(F.col("c"), 0, 0, 500)) == [3, 0, 0, 500]


@pytest.mark.parametrize("default", [True, False])
def test_flag(evaluate, default):
    texts = one(["true", "false", None, "maybe", "TRUE"])
    expected = [True, False, default, default, True]
    assert evaluate("c string", texts, C.flag(F.col("c"), default)) == expected


def test_boolean_words(evaluate):
    texts = one(["T", "Yes", "0", "maybe", None, "y", "N", "1", "False"])
    expected = [True, True, False, None, None, True, False, True, False]
    assert evaluate("c string", texts, C.boolean_word(F.col("c"))) == expected
    with_default = [e if e is not None else False for e in expected]
    assert evaluate("c string", texts, C.boolean_word(F.col("c"), False)) == with_default


def test_not_before(evaluate):
    rows = [
        (D(2024, 5, 10), D(2024, 5, 9)),
        (D(2024, 5, 10), D(2024, 5, 10)),
        (D(2024, 5, 10), None),
        (None, D(2024, 5, 9)),
    ]
    expected = [D(2024, 5, 11), D(2024, 5, 10), None, D(2024, 5, 9)]
    rule = C.not_before(F.col("finish"), F.col("begin"))
    assert evaluate("begin date, finish date", rows, rule) == expected


def test_email(evaluate):
    assert evaluate("c string", one(["A@B.C", None]), C.email(F.col("c"), "d@e.f")) == [
        "a@b.c",
        "d@e.f",
    ]


def test_birth_date(evaluate):
    as_of = D(2026, 1, 1)
    oldest_minor = as_of - timedelta(days=365 * 18 - 1)
    just_adult = as_of - timedelta(days=365 * 18)
    rows = one([D(2015, 1, 1), None, D(1980, 1, 1), oldest_minor, just_adult])
    filled = as_of - timedelta(days=9125)
    expected = [filled, filled, D(1980, 1, 1), filled, just_adult]
    assert evaluate("c date", rows, C.adult_birth_date(F.col("c"), as_of)) == expected


def test_late_return(evaluate):
    rows = [
        (D(2024, 5, 10), D(2024, 5, 12)),
        (D(2024, 5, 10), D(2024, 5, 8)),
        (D(2024, 5, 10), None),
        (None, D(2024, 5, 8)),
    ]
    schema = "s date, a date"
    late = evaluate(schema, rows, C.is_late(F.col("a"), F.col("s")))
    days = evaluate(schema, rows, C.late_days(F.col("a"), F.col("s")))
    assert late == [True, False, False, False]
    assert days == [2, 0, None, None]


def test_full_name(evaluate):
    rows = [(None, "B"), ("A", None), ("A", "B"), (None, None)]
    rule = C.full_name(F.col("f"), F.col("l"))
    assert evaluate("f string, l string", rows, rule) == [" B", "A ", "A B", " "]


def test_date_key(evaluate):
    rows = one([D(2024, 1, 7), None])
    assert evaluate("d date", rows, C.date_key(F.col("d"))) == [20240107, None]
