from __future__ import annotations

import unicodedata
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shopgrain.functions import clean
from shopgrain.functions import vocabulary as words
from shopgrain.operators.dims import gender_label


@pytest.fixture(scope="module")
def apply(spark):
    """The results of a column helper over a list of values."""

    def run(helper, values, kind="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        rows = frame.select("i", helper(F.col("v")).alias("r")).orderBy("i").collect()
        return [row["r"] for row in rows]

    return run


def test_dates(apply):
    values = ["2024-01-05", "2024-1-5", "2024-01-05 10:11:12.000", "20240105", "", None, "junk", "05/01/2024", "20241399"]
    found = apply(clean.parse_date, values)
    assert found == [date(2024, 1, 5)] * 4 + [None] * 5


def test_dates_in_a_given_format(apply):
    assert apply(lambda c: clean.parse_date(c, ["dd/MM/yyyy"]), ["05/01/2024"]) == [date(2024, 1, 5)]


def test_dates_from_timestamps(apply):
    assert apply(clean.parse_date, [datetime(2024, 2, 29, 23, 59)], "timestamp_ntz") == [date(2024, 2, 29)]


def test_money_rounds_half_up_and_forgives(apply):
    values = ["1.005", " 12 ", "1,000", "", None, "junk", "-3"]
    assert apply(clean.money, values) == [D("1.01"), D("12.00"), None, None, None, None, D("-3.00")]


def test_whole_numbers(apply):
    assert apply(clean.whole, ["12", " 12 ", "12.7", "", None, "x"]) == [12, 12, None, None, None, None]


def test_flags(apply):
    values = ["1", "True", "true", "TRUE", "0", "False", None, "1 ", "yes"]
    assert apply(clean.flag, values) == [True, True, True, False, False, False, False, True, False]
    assert apply(clean.flag, [True, False, None], "boolean") == [True, False, False]
    assert apply(clean.flag, [1, 0, 2], "int") == [True, False, False]


def test_gender(apply):
    assert set(apply(gender_label, list(words.MALE_TEXT) + ["Nam  "])) == {"Nam"}
    assert set(apply(gender_label, list(words.FEMALE_TEXT) + [unicodedata.normalize("NFD", "Nữ")])) == {"Nữ"}
    assert set(apply(gender_label, ["", "  ", None, "mALE", "other"])) == {"Không xác định"}


def test_mentions_folds_case_and_unicode_form(apply):
    def cancelled(c):
        return clean.mentions(c, words.VIETNAMESE_CANCELLED)

    values = ["Đã hủy", "ĐÃ HUỶ", "hủy", unicodedata.normalize("NFD", "Đã Hủy"), "Đang giao", None, ""]
    assert apply(cancelled, values) == [True, True, True, True, False, False, False]


def test_keys(apply):
    days = [date(2024, 2, 29), None]
    assert apply(clean.date_key, days, "date") == [20240229, None]
    assert apply(clean.key_month, [20240229, None], "int") == [202402, None]


def test_joined_text_takes_null_as_empty(spark):
    rows = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "x string, y string")
    joined = rows.select(clean.joined_text(F.col("x"), F.col("y"), "_").alias("r")).collect()
    assert sorted(r["r"] for r in joined) == ["_b", "a_", "a_b"]


def test_text_stays_whole(apply):
    long = "a name of more than twenty-five characters"
    assert apply(clean.text, [long, None]) == [long, None]


def test_flags_are_read_to_their_end(apply):
    assert apply(clean.flag, ["1         no", " 1 ", "true ", "1" + " " * 30]) == [False, True, True, True]
