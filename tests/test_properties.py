"""Property checks on generated frames; few examples, each is a Spark job."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aeris.functions import buckets
from aeris.operators import enrich, impute, validate
from aeris.plans import cleaning as jobs
from aeris.plans.vulnerability import country_vulnerability

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
temp = st.one_of(st.none(), st.floats(min_value=-40, max_value=50, allow_nan=False).map(lambda x: round(x, 1)))
row = st.tuples(st.sampled_from(["A", "B", "C"]), temp, temp, temp)


@SETTINGS
@given(st.lists(row, min_size=1, max_size=25))
def test_imputation_keeps_order(spark, rows):
    df = spark.createDataFrame(rows, "station_id string, min_temp_c double, avg_temp_c double, max_temp_c double")
    for r in impute.impute_temperatures(df).collect():
        if None not in (r.min_temp_c, r.avg_temp_c):
            assert r.min_temp_c <= r.avg_temp_c
        if None not in (r.max_temp_c, r.avg_temp_c):
            assert r.avg_temp_c <= r.max_temp_c


precip = st.one_of(st.none(), st.floats(min_value=0, max_value=80, allow_nan=False).map(lambda x: round(x, 1)))
wrow = st.tuples(st.sampled_from(["1", "2"]), st.integers(0, 90), temp, temp, temp, precip)


@SETTINGS
@given(st.lists(wrow, min_size=1, max_size=30))
def test_risk_in_range_and_validation_idempotent(spark, rows):
    data = [(s, dt.date(2021, 1, 1) + dt.timedelta(days=d), "City", "Winter", a, mn, mx, p)
            for s, d, mn, a, mx, p in rows]
    df = spark.createDataFrame(data, "station_id string, date date, city_name string, season string, "
                                     "avg_temp_c double, min_temp_c double, max_temp_c double, "
                                     "precipitation_mm double")
    scored = enrich.enrich_weather(df)
    for r in scored.select("climate_risk_score").collect():
        assert 0 <= r[0] <= 3
    spec = jobs.weather_spec(min_rows=0)
    once = validate.validate(scored, spec, None).valid
    twice = validate.validate(once, spec, None)
    assert twice.summary()["count.final_count"] == once.count()


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["X", "Y", "Z"]), st.floats(0, 3, allow_nan=False)), min_size=1, max_size=40))
def test_vulnerability_percentages_sum_to_100(spark, rows):
    data = [(c, "2020-01-01", s) for c, s in rows]
    df = spark.createDataFrame(data, "city_name string, date string, climate_risk_score double")
    df = df.withColumn("climate_risk_level", buckets.climate_risk_level())
    cities = spark.createDataFrame([("1", "X", "Xland")], "station_id string, city_name string, country string")
    for r in country_vulnerability(df, cities).collect():
        total = r.pct_low + r.pct_moderate + r.pct_high + r.pct_critical
        assert abs(total - 100.0) <= 0.02 + 1e-9
        assert r.low_cnt + r.moderate_cnt + r.high_cnt + r.critical_cnt == r.events
