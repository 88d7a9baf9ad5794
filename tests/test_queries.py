import datetime as dt

import pytest

from aeris.plans import climate_queries as cq
from aeris.plans.vulnerability import country_vulnerability

D1, D2 = dt.date(2020, 7, 1), dt.date(2020, 7, 2)
CO2 = "country string, date date, sector string, MtCO2_per_day double"
CITIES = "station_id string, city_name string, country string, iso3 string"
WEATHER = ("station_id string, date date, avg_temp_c double, max_temp_c double, "
           "climate_risk_score double, climate_risk_level string")


@pytest.fixture
def dims(spark):
    cities = spark.createDataFrame([
        ("1", "Alpha", "Aland", "ALA"), ("2", "Beta", "Aland", "ALA"),
        ("3", "Gamma", "Bland", "BLA"), ("4", "Delta", "Aland", "ALA")], CITIES)
    countries = spark.createDataFrame([("Aland", "ALA"), ("Bland", "BLA")], "country string, iso3 string")
    return cities, countries


def test_top_emission_day_tie_breaks_and_hottest_cities(spark, dims):
    cities, _ = dims
    co2 = spark.createDataFrame([
        ("Aland", D2, "Power", 5.0), ("Bland", D1, "Power", 5.0),   # equal totals: earlier date wins
        ("Aland", D1, "Power", 1.0)], CO2)
    weather = spark.createDataFrame([
        ("1", D1, 20.0, 30.0, 1.0, "LOW"), ("2", D1, 20.0, 30.0, 1.0, "LOW"),   # tie on max -> by name
        ("3", D1, 20.0, 25.0, 1.0, "LOW"), ("4", D1, 20.0, None, 1.0, "LOW")], WEATHER)
    out = cq.top_emission_day_with_cities(co2, weather, cities).collect()
    assert len(out) == 1 and out[0]["date"] == D1 and out[0]["country"] == "Bland"
    assert [(c["city_name"], c["max_temp"]) for c in out[0]["hottest_cities"]] == [("Gamma", 25.0)]
    out_a = cq.top_emission_day_with_cities(co2, weather, cities, country="Aland").collect()[0]
    assert out_a["date"] == D2 and out_a["hottest_cities"] == []          # no weather that day
    out_b = cq.top_emission_day_with_cities(
        co2.filter("country = 'Aland' AND date = DATE'2020-07-01'"), weather, cities).collect()[0]
    assert [c["city_name"] for c in out_b["hottest_cities"]] == ["Alpha", "Beta", "Delta"]  # null last


def test_extreme_weather_threshold_and_missing_emission(spark, dims):
    cities, _ = dims
    co2 = spark.createDataFrame([("Aland", D1, "Power", 2.0), ("Aland", D1, "Transport", None)], CO2)
    weather = spark.createDataFrame([
        ("1", D1, 30.0, 35.0, 1.0, "LOW"),      # exactly at threshold: kept by the pre-filter
        ("2", D1, 30.0, 36.0, 2.0, "HIGH"),
        ("4", D2, 30.0, 40.0, 2.0, "HIGH"),     # no emission that day: dropped
        ("3", D1, 30.0, 35.0, 1.0, "LOW")],     # group max == threshold: not > threshold
        WEATHER)
    out = cq.emission_vs_extreme_weather(weather, cities, co2).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["country"], r["date"], r["extreme_events"], r["max_temp"], r["total_emission"]) == (
        "Aland", D1, 2, 36.0, 2.0)
    assert r["avg_risk"] == pytest.approx(1.5)


def test_monthly_fanout_true_vs_reproduced(spark, dims):
    cities, countries = dims
    co2 = spark.createDataFrame([("Aland", D1, s, 1.0) for s in ("A", "B", "C")], CO2)
    weather = spark.createDataFrame([("1", D1, 10.0, 20.0, 0.0, "LOW"), ("2", D1, 20.0, 20.0, 0.0, "LOW")],
                                    WEATHER)
    fan = cq.monthly_temp_and_co2(weather, cities, countries, co2, limit=None).collect()[0]
    true = cq.monthly_temp_and_co2(weather, cities, countries, co2, limit=None, dedup_fanout=True).collect()[0]
    assert fan["monthly_total_co2"] == 6.0 and true["monthly_total_co2"] == 3.0
    assert fan["monthly_avg_temp"] == true["monthly_avg_temp"] == 15.0
    assert fan["month"] == "2020-07"
    assert [(s["date"], s["co2"]) for s in fan["daily_sample"]] == [(D1, 6.0)]


def test_hot_cities(spark, dims):
    cities, countries = dims
    co2 = spark.createDataFrame([("Aland", D1, "P", 2.0), ("Aland", D2, "P", 4.0)], CO2)
    weather = spark.createDataFrame([
        ("1", D1, 31.0, 35.0, 0.0, "LOW"), ("1", D2, 32.0, 35.0, 0.0, "LOW"),
        ("2", D1, 31.0, 35.0, 0.0, "LOW"), ("2", None, 31.0, 35.0, 0.0, "LOW"),
        ("3", D1, 40.0, 45.0, 0.0, "LOW"),      # Bland has no CO2 rows: dropped
        ("4", D1, 30.0, 35.0, 0.0, "LOW")], WEATHER)   # not above 30
    got = [tuple(r) for r in cq.hot_cities_vs_co2(weather, cities, countries, co2).collect()]
    assert got == [("Alpha", "Aland", 2, 3.0), ("Beta", "Aland", 1, 3.0)]


def test_vulnerability_unknown_and_hyphenated(spark):
    cities = spark.createDataFrame([("1", "Rostov-on-Don", "Russia"), ("2", "Paris", "France")],
                                   "station_id string, city_name string, country string")
    weather = spark.createDataFrame([
        ("Rostov-on-don", "2020-01-01", 2.6, "CRITICAL"), ("Paris", "2020-01-01", 0.2, "LOW"),
        ("Paris", "2020-01-02", 1.6, "HIGH"), ("Atlantis", "2020-01-01", 0.6, "MODERATE")],
        "city_name string, date string, climate_risk_score double, climate_risk_level string")
    got = {r["country"]: r for r in country_vulnerability(weather, cities).collect()}
    assert set(got) == {"Russia", "France", "Unknown"}
    fr = got["France"]
    assert (fr["events"], fr["high_cnt"], fr["pct_worst"], fr["high_risk_days_ratio"]) == (2, 1, 50.0, 0.5)
    assert fr["avg_risk_score"] == 0.9 and fr["climate_vulnerability_index"] == 0.34
    assert fr["vulnerability_category"] == "MODERATE"
    strict = {r["country"] for r in country_vulnerability(weather, cities, standardize_dimension=False).collect()}
    assert "Russia" not in strict                    # raw hyphenated name does not match
    total = fr["pct_low"] + fr["pct_moderate"] + fr["pct_high"] + fr["pct_critical"]
    assert total == pytest.approx(100.0, abs=0.05)


def test_reports_relabel_and_round(spark, dims):
    from aeris.plans import reports
    cities, countries = dims
    co2 = spark.createDataFrame([("Aland", D1, "P", 2.123456)], CO2)
    weather = spark.createDataFrame([("1", D1, 31.0, 36.0, 1.234, "HIGH")], WEATHER)
    r = reports.extreme_weather_report(cq.emission_vs_extreme_weather(weather, cities, co2)).collect()[0]
    assert r["Avg Risk Score"] == 1.23 and r["Total Emission (MtCO₂/day)"] == 2.1235
    h = reports.hot_cities_report(cq.hot_cities_vs_co2(weather, cities, countries, co2)).collect()[0]
    assert (h["City"], h["Hot Days Count"], h["Avg CO₂ (MtCO₂/day)"]) == ("Alpha", 1, 2.12)
    t = reports.top_day_report(cq.top_emission_day_with_cities(co2, weather, cities)).collect()
    assert [(x["City"], x["Max Temp (°C)"]) for x in t] == [("Alpha", 36.0)]
