"""A key holding a third of all rows: results stay exact and plans combine map-side."""

import contextlib
import datetime as dt
import io

import pandas as pd
import pytest

from aeris.operators import cleaning, enrich, impute
from aeris.plans.vulnerability import country_vulnerability


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30000
    start = dt.date(2020, 1, 1)
    data = []
    for i in range(n):
        station = "HOT" if i % 3 == 0 else f"S{i % 97}"
        d = start + dt.timedelta(days=(i * 7) % 400)
        data.append((station, d, float(i % 41) - 5.0, float(i % 13), i))
    df = spark.createDataFrame(data, "station_id string, date date, avg_temp_c double, "
                                     "precipitation_mm double, k int").repartition(8)
    return df, pd.DataFrame(data, columns=["station_id", "date", "avg_temp_c", "precipitation_mm", "k"])


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_dedup_hot_key_exact_and_partial(skewed):
    df, pdf = skewed
    out = cleaning.dedup_by_key(df, ["station_id", "date"])
    want = pdf.sort_values(["avg_temp_c", "precipitation_mm", "k"]).groupby(["station_id", "date"]).head(1)
    got = out.toPandas()
    assert len(got) == len(want)
    merged = got.merge(want, on=["station_id", "date"], suffixes=("", "_w"))
    assert (merged.k == merged.k_w).all()
    plan = _plan(out)
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "WindowGroupLimit" in plan[:plan.index("Exchange")]   # one row a key and task


def test_station_stats_are_partial(skewed):
    df, pdf = skewed
    out = impute.impute_temperatures(df, mean_cols=["avg_temp_c"], min_col="avg_temp_c",
                                     max_col="avg_temp_c")
    assert out.count() == len(pdf)
    spi = enrich.add_spi_index(df)
    plan = _plan(spi)
    assert "partial_" in plan and "InMemory" not in plan
    hot = spi.filter("station_id = 'HOT'").select("spi_index").distinct().count()
    assert hot > 1


def test_vulnerability_with_hot_country(spark, skewed):
    df, pdf = skewed
    weather = df.selectExpr("CASE WHEN station_id = 'HOT' THEN 'Hot City' ELSE station_id END AS city_name",
                            "CAST(date AS STRING) AS date", "precipitation_mm / 4 AS climate_risk_score",
                            "CASE WHEN precipitation_mm > 10 THEN 'HIGH' ELSE 'LOW' END AS climate_risk_level")
    cities = spark.createDataFrame([("1", "Hot City", "Hotland")], "station_id string, city_name string, country string")
    got = {r["country"]: r["events"] for r in country_vulnerability(weather, cities).collect()}
    assert got == {"Hotland": 10000, "Unknown": 20000}
