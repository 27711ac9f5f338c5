"""Golden rows for the scalar operators (edge values of FIXTURES.md section 5)."""

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from furlong.functions import exprs as X


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def col_values(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def python_extract(x):
    # The notebook's rule, evaluated by Python's own regex engine.
    if x is None:
        return None
    found = re.findall(r"/(\w+)/$", x)
    return found[0] if found else None


URLS = ["https://h.example/r/12/", "https://h.example/r/12", "https://h.example/r/馬1/",
        "https://h.example/r/12/\n", "https://h.example/r/12/\r\n", "", None,
        "https://db.example/race/202004040406/", "https://h.example/a_b/x-y/", "/x//"]


def test_extract_url_id_matches_python_rule(spark):
    got = col_values(one_col(spark, URLS), X.extract_url_id("v"))
    assert got == [python_extract(u) for u in URLS]
    assert got[:7] == ["12", None, "馬1", "12", None, None, None]


def test_parse_clock(spark):
    df = one_col(spark, ["1:34.5", None, "0:59.9", "2:00.0"])
    assert col_values(df, X.parse_clock("v")) == [94.5, None, 59.9, 120.0]


def test_parse_clock_without_colon_strict_and_lenient(spark):
    df = one_col(spark, ["94.5"])
    with pytest.raises(PySparkException):
        df.select(X.parse_clock("v")).collect()
    assert col_values(df, X.parse_clock("v", lenient=True)) == [None]


def test_held_date_month_and_weekday(spark):
    df = one_col(spark, ["2020年4月4日", "2020年4月5日", "1999年12月31日", None])
    assert col_values(df, X.parse_held_date("v")) == [dt.date(2020, 4, 4), dt.date(2020, 4, 5),
                                                      dt.date(1999, 12, 31), None]
    assert col_values(df, X.held_month("v")) == ["4月", "4月", "12月", None]
    # 2020-04-05 is a Sunday: 1; 2020-04-04 a Saturday: 7
    assert col_values(df, X.held_day_of_week("v")) == [7, 1, 6, None]


def test_held_month_without_mark_is_null(spark):
    assert col_values(one_col(spark, ["2020年"]), X.held_month("v")) == [None]


def test_invalid_date_strict_and_lenient(spark):
    df = one_col(spark, ["2020年13月1日"])
    with pytest.raises(PySparkException):
        df.select(X.parse_held_date("v")).collect()
    with pytest.raises(PySparkException):
        df.select(X.held_day_of_week("v")).collect()
    assert col_values(df, X.parse_held_date("v", lenient=True)) == [None]
    assert col_values(df, X.held_day_of_week("v", lenient=True)) == [None]


def test_length_band_edges(spark):
    df = one_col(spark, [1399, 1400, 1799, 1800, 2199, 2200, 2799, 2800, None], "bigint")
    assert col_values(df, X.length_band("v")) == [
        "短距離", "マイル", "マイル", "中距離", "中距離", "中長距離", "中長距離", "長距離", "長距離"]


def test_safe_arrival_order(spark):
    df = one_col(spark, ["6", "中止", "3(降)", "3.0", None, "18"])
    assert col_values(df, X.safe_to_long("v")) == [6, None, None, None, None, 18]


def test_division_by_zero_strict_and_lenient(spark):
    df = spark.createDataFrame([(0, "55.0", "0")], "i int, j string, h string")
    with pytest.raises(PySparkException):
        df.select(X.weight_ratio("j", "h")).collect()
    assert col_values(df, X.weight_ratio("j", "h", lenient=True)) == [None]


def test_casts_to_long(spark):
    with pytest.raises(PySparkException):
        one_col(spark, ["3.0"]).select(X.to_long("v")).collect()
    df = one_col(spark, [2.5, -2.5, 2.4, None], "double")
    assert col_values(df, X.double_to_long("v")) == [3, -3, 2, None]


def test_ratios(spark):
    df = spark.createDataFrame([(0, "1800", "1:48.0", "36.0", "54.0", "450")],
                               "i int, l string, g string, h string, j string, w string")
    r = df.select(X.avg_velocity("l", "g").alias("v"), X.avg_half_velocity("l", "h").alias("hv"),
                  X.weight_ratio("j", "w").alias("wr")).first()
    assert r.v == pytest.approx(1800 / 108.0)
    assert r.hv == pytest.approx(900 / 36.0)
    assert r.wr == pytest.approx(54.0 / 450.0)


def test_central_place_drops_null(spark):
    df = one_col(spark, ["東京", "大井", None])
    assert [r.i for r in df.where(X.central_place("v", ["東京"])).collect()] == [0]


STRICT_FAILS = [("to_double", "1.5d"), ("to_double", "0x1p3"), ("to_double", "abc"), ("parse_clock", "1:3d"),
                ("parse_held_date", "2020年4"), ("parse_held_date", "2020年4月4日 x"),
                ("parse_held_date", "2020-04-04T99"), ("parse_held_date", "2020年13月1日"),
                ("held_day_of_week", "99999999999年4月4日")]


@pytest.mark.parametrize("name,bad", STRICT_FAILS)
def test_strict_fails_and_lenient_gives_null(spark, name, bad):
    df = one_col(spark, [bad])
    with pytest.raises(Exception):
        df.select(getattr(X, name)("v")).collect()
    assert df.select(getattr(X, name)("v", lenient=True)).first()[0] is None


def test_plain_numbers_and_dates_still_pass(spark):
    df = one_col(spark, ["1.5", " 2 ", "-.5", "+3.", "1e3", None])
    assert [r[0] for r in df.orderBy("i").select(X.to_double("v")).collect()] == [1.5, 2.0, -0.5, 3.0, 1000.0, None]
    df = one_col(spark, ["2020年4月4日", "2020年12月31日", None])
    assert [str(r[0]) for r in df.orderBy("i").select(X.parse_held_date("v")).collect()] == [
        "2020-04-04", "2020-12-31", "None"]
