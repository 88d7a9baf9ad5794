import datetime as dt

from pyspark.sql import functions as F

from aeris.functions import buckets, scrub
from aeris.functions.dates import parse_multi_format_date
from aeris.operators.cleaning import scrub_columns


def test_scrub_double_and_int(spark):
    df = spark.createDataFrame(
        [("1,234.5",), ("-3",), ("abc",), ("",), (None,), ("12.5kg",)], "raw string")
    out = df.select("raw", scrub.to_double("raw").alias("d"), scrub.to_int("raw").alias("i")).collect()
    got = {r["raw"]: (r["d"], r["i"]) for r in out}
    assert got["1,234.5"] == (1234.5, 12345)
    assert got["-3"] == (-3.0, 3)          # the integer scrub drops the sign
    assert got["abc"] == (None, None)
    assert got[""] == (None, None)
    assert got[None] == (None, None)
    assert got["12.5kg"] == (12.5, 125)


def test_numeric_columns_pass_unchanged(spark):
    df = spark.createDataFrame([(0.0001,), (12345678.9,)], "x double")
    out = scrub_columns(df, double=["x"]).collect()
    assert sorted(r["x"] for r in out) == [0.0001, 12345678.9]


def test_keep_alpha(spark):
    df = spark.createDataFrame([("Win_ter 2&",), ("St. John's·-x",), ("Été",)], "s string")
    out = [r[0] for r in df.select(scrub.keep_alpha("s")).collect()]
    assert out == ["Winter ", "St. John's·-x", "t"]


def test_multi_format_dates(spark):
    raw = ["05/01/2020", "5/1/2020", "2020-01-05", "2020/01/05", "05012020", "bad", None]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    out = [r[0] for r in df.select(parse_multi_format_date("raw")).collect()]
    jan5 = dt.date(2020, 1, 5)
    assert out == [jan5, jan5, jan5, jan5, jan5, None, None]


def _bucket(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_temperature_buckets(spark):
    vals = [None, -0.1, 0.0, 9.9, 10.0, 19.9, 20.0, 29.9, 30.0]
    assert _bucket(spark, buckets.temp_category, vals) == [
        None, "Freezing", "Cold", "Cold", "Mild", "Mild", "Warm", "Warm", "Hot"]


def test_precipitation_buckets(spark):
    vals = [None, 0.0, 0.1, 2.4, 2.5, 9.9, 10.0, 49.9, 50.0]
    assert _bucket(spark, buckets.precipitation_category, vals) == [
        None, "No Rain", "Light Rain", "Light Rain", "Moderate Rain", "Moderate Rain",
        "Heavy Rain", "Heavy Rain", "Very Heavy Rain"]


def test_emission_buckets(spark):
    vals = [0.0, 0.09, 0.1, 0.99, 1.0, 9.99, 10.0, 49.9, 50.0, None]
    assert _bucket(spark, buckets.emission_level, vals) == [
        "Zero", "Very Low", "Low", "Low", "Medium", "Medium", "High", "High", "Very High", "Very High"]


def test_risk_level_and_vulnerability_buckets(spark):
    assert _bucket(spark, buckets.climate_risk_level, [0.49, 0.5, 1.49, 1.5, 2.49, 2.5]) == [
        "LOW", "MODERATE", "MODERATE", "HIGH", "HIGH", "CRITICAL"]
    assert _bucket(spark, buckets.vulnerability_category, [0.3, 0.31, 0.5, 0.51, 0.7, 0.71]) == [
        "LOW", "MODERATE", "MODERATE", "HIGH", "HIGH", "EXTREME"]


def test_sector_category(spark):
    df = spark.createDataFrame([("Power",), ("aviation",), ("Industry",), ("Residential",), ("Mining",)], "s string")
    folded = [r[0] for r in df.select(buckets.sector_category("s")).collect()]
    strict = [r[0] for r in df.select(buckets.sector_category("s", case_sensitive=True)).collect()]
    assert folded == ["Energy", "Transportation", "Industrial", "Buildings", "Other"]
    assert strict == ["Other", "Transportation", "Other", "Other", "Other"]


def test_risk_score_bounds_and_weights(spark):
    df = spark.createDataFrame(
        [(36.0, 5.0, 60.0, 2.5), (20.0, 5.0, 5.0, 0.2), (31.0, -11.0, 0.0, 1.2), (None, None, None, None)],
        "max_temp_c double, min_temp_c double, precipitation_mm double, spi_index double")
    out = [r[0] for r in df.select(buckets.climate_risk_score()).collect()]
    assert out == [3.0, 0.0, 1.5, 0.0]
    assert all(0 <= v <= 3 for v in out)


def test_temp_range(spark):
    df = spark.createDataFrame([(10.0, 2.5), (None, 1.0), (1.0, 5.0)], "max_temp_c double, min_temp_c double")
    assert [r[0] for r in df.select(buckets.temp_range()).collect()] == [7.5, None, 4.0]
