import datetime as dt

import pytest

from mastlight.functions import geo, parsing
from pyspark.sql import functions as F


def evaluate(spark, build, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.selectExpr(f"{build('v')} AS r").first().r


NUMBERS = [(None, None), ("", None), ("4.2", 4.2), ("x", None), ("1e2", 100.0), ("12abc", None), ("Infinity", None),
           ("NaN", None), ("1.0d", None), (" -83.5 ", -83.5), ("1e999", None), ("0x1F", 31.0), ("0b101", 5.0), (".5", 0.5),
           ("5.", 5.0), ("   ", 0.0), ("1,5", None)]


@pytest.mark.parametrize("text,expected", NUMBERS)
def test_number(spark, text, expected):
    assert evaluate(spark, parsing.number, text) == expected


@pytest.mark.parametrize("text,expected", [
    (None, None), ("", None), ("42.9", 42), (" 7ms", 7), ("-3", -3), ("1e3", 1), ("abc", None), ("+5", 5),
    ("99999999999", None)])
def test_leading_int(spark, text, expected):
    assert evaluate(spark, parsing.leading_int, text) == expected


def test_leading_int_as_bigint(spark):
    assert evaluate(spark, lambda v: parsing.leading_int(v, "bigint"), "99999999999") == 99999999999


@pytest.mark.parametrize("text,expected", [("6.5N", 6.5), ("-1e1x", -10.0), ("N6", None), (None, None)])
def test_leading_float(spark, text, expected):
    assert evaluate(spark, parsing.leading_float, text) == expected


@pytest.mark.parametrize("value,low,high,expected", [
    (-200.0, -140, -20, -140.0), (-83.0, -140, -20, -83.0), (0.0, -140, -20, -20.0), (None, 0, 5000, None)])
def test_clamp(spark, value, low, high, expected):
    assert evaluate(spark, lambda v: parsing.clamp(v, low, high), value, "double") == expected


@pytest.mark.parametrize("text,expected", [(" Lagos ", "Lagos"), ("  ", "Unkno"), ("Port Harcourt", "Port "), (None, "Unkno")])
def test_clean_text(spark, text, expected):
    assert evaluate(spark, lambda v: parsing.clean_text(v, "Unknown", 5), text) == expected


@pytest.mark.parametrize("text,api,loader", [
    ("nr", "5G", "5G"), (" lte ", "4G", "4G"), ("HSPA", "3G", "3G"), ("edge", "2G", "2G"), (None, "4G", "4G"),
    ("wifi", "4G", "WIFI")])
def test_network(spark, text, api, loader):
    assert evaluate(spark, lambda v: parsing.network_generation(v, "4G"), text) == api
    assert evaluate(spark, parsing.network_generation, text) == loader
    assert parsing.network_parameter(text) == api


@pytest.mark.parametrize("words,text,expected", [
    ("plain", "yes", True), ("plain", "N", False), ("plain", "maybe", None), ("plain", None, None), ("plain", "met", None),
    ("sla", "met", True), ("sla", "missed", False), ("handover", "completed", True), ("handover", "dropped", False),
    ("technician", "resolved", True), ("technician", "failed", False)])
def test_boolean(spark, words, text, expected):
    assert evaluate(spark, lambda v: parsing.boolean(v, words), text) is expected


@pytest.mark.parametrize("text,expected", [
    ("2024-03-01T10:00:00.123987Z", dt.datetime(2024, 3, 1, 10, 0, 0, 123000)),
    ("2024-03-01", dt.datetime(2024, 3, 1)), ("2024-03-01 10:00:00+02:00", dt.datetime(2024, 3, 1, 8)),
    ("3/15/2024 9:05", dt.datetime(2024, 3, 15, 9, 5)), ("2024/3/5", dt.datetime(2024, 3, 5)),
    ("10:00:00", None), ("soon", None), ("", None), (None, None), ("2024-13-01", None)])
def test_timestamp(spark, text, expected):
    assert evaluate(spark, parsing.timestamp, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("2024-03", dt.date(2024, 3, 1)), ("2024-03-15", dt.date(2024, 3, 15)), ("", None), (None, None)])
def test_month(spark, text, expected):
    assert evaluate(spark, parsing.month_start, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("1700000000", dt.datetime(2023, 11, 14, 22, 13, 20)), ("1700000000000", dt.datetime(2023, 11, 14, 22, 13, 20)),
    ("2023-11-14T22:13:20Z", dt.datetime(2023, 11, 14, 22, 13, 20)), (None, None), ("", None), ("1e30", None)])
def test_epoch_or_text(spark, text, expected):
    assert evaluate(spark, lambda v: parsing.epoch_or_text_timestamp(v, f"({parsing.number(v)})"), text) == expected


@pytest.mark.parametrize("end,expected", [(90, 2), (89, 1), (-50, 0), (None, None)])
def test_minutes_between(spark, end, expected):
    start = dt.datetime(2024, 1, 1)
    stop = None if end is None else start + dt.timedelta(seconds=end)
    df = spark.createDataFrame([(start, stop)], "a timestamp_ntz, b timestamp_ntz")
    assert df.selectExpr(f"{parsing.minutes_between('a', 'b')} AS r").first().r == expected


@pytest.mark.parametrize("lat,lon,city", [(6.52, 3.38, "Lagos"), (7.0, 3.35, "Abeokuta"), (12.0, 8.6, "Kano")])
def test_nearest_city(spark, lat, lon, city):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.select(geo.nearest_city(F.col("lat"), F.col("lon")).alias("c")).first().c == city


def test_first_present_skips_absent_and_empty(spark):
    df = spark.createDataFrame([("", "b", "c")], "x string, y string, z string")
    assert df.selectExpr(f"{parsing.first_present(df.columns, ['w', 'x', 'y', 'z'])} AS r").first().r == "b"
    assert df.selectExpr(f"{parsing.first_present(df.columns, ['w'])} AS r").first().r is None


@pytest.mark.parametrize("text", [
    "Mon, 15 Jan 2024 10:00:00 GMT", "Jan 15, 2024 10:00", "January 15 2024 10:00:00", "15 January 2024 10:00",
    "1/15/2024 10:00 AM", "\t2024-01-15T10:00:00Z\r\n", " 2024/1/15 10:00　"])
def test_date_forms(spark, text):
    found = spark.range(1).selectExpr(f"{parsing.timestamp(parsing.quoted(text))} AS t").first().t
    assert found == dt.datetime(2024, 1, 15, 10)


def test_evening_and_unknown_dates(spark):
    row = spark.range(1).selectExpr(f"{parsing.timestamp(parsing.quoted('1/15/2024 10:00 pm'))} AS t",
                                    f"{parsing.timestamp(parsing.quoted('15 Foo 2024'))} AS u").first()
    assert row.t == dt.datetime(2024, 1, 15, 22) and row.u is None


def test_all_blank_characters_are_stripped(spark):
    row = spark.range(1).selectExpr(
        f"{parsing.number(parsing.quoted(chr(9) + '12' + chr(10)))} AS n",
        f"{parsing.clean_text(parsing.quoted('MTN' + chr(9)), 'Unknown', 20)} AS c",
        f"{parsing.network_generation(parsing.quoted('5G' + chr(9)))} AS g",
        f"{parsing.boolean(parsing.quoted(chr(160) + 'yes' + chr(13)))} AS b").first()
    assert (row.n, row.c, row.g, row.b) == (12.0, "MTN", "5G", True)
