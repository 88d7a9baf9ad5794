import itertools
import math
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aeris.functions.numeric import exact_avg, exact_sum
from aeris.operators import cleaning, enrich, impute, validate
from aeris.operators.joins import semi_join_reference
from aeris.plans import cleaning as jobs
from aeris.plans import climate_queries as cq
from tests.conftest import rows

TEMP_SCHEMA = "station_id string, k int, min_temp_c double, avg_temp_c double, max_temp_c double"


def brute_impute(pdf: pd.DataFrame) -> pd.DataFrame:
    """Row-by-row reference of the imputation rules."""
    means = pdf.groupby("station_id", dropna=False)[["min_temp_c", "avg_temp_c", "max_temp_c"]].mean()

    def nn(x):
        return x is not None and not (isinstance(x, float) and math.isnan(x))

    def gl(f, *xs):
        xs = [x for x in xs if nn(x)]
        return f(xs) if xs else None

    out = []
    for _, r in pdf.iterrows():
        m = means.loc[r.station_id]
        pmin, pavg, pmax = (m.min_temp_c, m.avg_temp_c, m.max_temp_c)
        pmin, pavg, pmax = [None if not nn(v) else v for v in (pmin, pavg, pmax)]
        mn, avg, mx = [None if not nn(v) else v for v in (r.min_temp_c, r.avg_temp_c, r.max_temp_c)]
        if avg is None:
            if mn is not None and mx is not None:
                avg = pavg if (pavg is not None and mn <= pavg <= mx) else (mn + mx) / 2
            elif mn is not None:
                avg = gl(max, pavg, mn)
            elif mx is not None:
                avg = gl(min, pavg, mx)
            else:
                avg = pavg
        if mn is None:
            mn = gl(min, pmin, avg) if avg is not None else (gl(min, pmin, mx) if mx is not None else pmin)
        if mx is None:
            mx = gl(max, pmax, avg) if avg is not None else (gl(max, pmax, mn) if mn is not None else pmax)
        if mn is not None and avg is not None and mn > avg:
            mn = avg
        if mx is not None and avg is not None and mx < avg:
            mx = avg
        out.append((r.station_id, r.k, mn, avg, mx))
    return out


def test_imputation_all_null_patterns(spark):
    data, k = [], 0
    # every one of the 8 null patterns, in a station with a full history
    for pattern in itertools.product([True, False], repeat=3):
        vals = [None if p else v for p, v in zip(pattern, (5.0, 10.0, 20.0))]
        data.append(("S1", k, *vals)); k += 1
    data += [("S1", 100, 1.0, 2.0, 3.0), ("S1", 101, 4.0, 30.0, 40.0)]   # station mean of avg ~ 14
    # a station whose mean of avg lies outside the row's bounds, and one without any mean
    data += [("S2", 200, 0.0, 50.0, 60.0), ("S2", 201, 1.0, None, 2.0)]
    data += [("S3", 300, None, None, 4.0), ("S3", 301, None, None, None)]
    df = spark.createDataFrame(data, TEMP_SCHEMA)
    got = {(r[0], r[1]): r for r in rows(impute.impute_temperatures(df), "station_id", "k", "min_temp_c",
                                          "avg_temp_c", "max_temp_c")}
    want = {(r[0], r[1]): r for r in brute_impute(df.toPandas())}
    assert got.keys() == want.keys()
    for key, g in got.items():
        for a, b in zip(g[2:], want[key][2:]):
            assert (a is None and b is None) or a == pytest.approx(b), key
    for _, _, mn, avg, mx in got.values():
        if None not in (mn, avg, mx):
            assert mn <= avg <= mx


def test_global_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    out = sorted(r[0] for r in impute.global_median_fill(df, ["x"], 1_000_000).collect())
    assert out == [1.0, 2.0, 2.0, 3.0, 4.0]


def brute_spi(pdf: pd.DataFrame) -> dict:
    pdf = pdf.copy()
    pdf["y"] = pdf.date.map(lambda d: d.year)
    pdf["m"] = pdf.date.map(lambda d: d.month)
    pdf["w1"] = pdf.groupby(["station_id", "y", "m"]).precipitation_mm.transform("mean")
    pdf["w2"] = pdf.groupby("station_id").w1.transform("mean")
    pdf["w3"] = pdf.groupby("station_id").w1.transform(lambda s: s.std(ddof=1))
    out = {}
    for _, r in pdf.iterrows():
        v = None
        if not (pd.isna(r.w3) or r.w3 == 0 or pd.isna(r.w1)):
            v = round((r.w1 - r.w2) / r.w3, 1) + 0.0
        out[r.k] = v
    return out


def test_spi_index_cases(spark):
    import datetime as dt
    data = []
    k = 0
    for day in range(1, 4):   # one month only -> stddev undefined -> null
        data.append(("ONE", k, dt.date(2020, 1, day), float(day))); k += 1
    for mon in range(1, 4):   # constant rain -> stddev 0 -> null
        data.append(("FLAT", k, dt.date(2020, mon, 1), 2.0)); k += 1
    vals = [0.0, 4.0, 8.0, 1.0, 3.0, 30.0, 0.5, None, 2.0, 12.0]
    for i, v in enumerate(vals):   # several months of unequal length
        data.append(("MANY", k, dt.date(2020, 1 + i % 4, 1 + i), v)); k += 1
    df = spark.createDataFrame(data, "station_id string, k int, date date, precipitation_mm double")
    got = {r["k"]: r["spi_index"] for r in enrich.add_spi_index(df).collect()}
    want = brute_spi(df.toPandas())
    assert got.keys() == want.keys()
    for key in got:
        assert got[key] == want[key], key
    assert all(got[i] is None for i in range(6))


def test_dedup_is_deterministic_and_prefers_complete_rows(spark):
    df = spark.createDataFrame(
        [("A", 1, 3.0, "z"), ("A", 1, 1.0, "y"), ("A", 1, None, "x"), ("B", 2, 5.0, "q"), ("C", 3, None, "b"),
         ("C", 3, None, "a")],
        "s string, d int, v double, t string")
    got = rows(cleaning.dedup_by_key(df, ["s", "d"]))
    assert got == [("A", 1, 1.0, "y"), ("B", 2, 5.0, "q"), ("C", 3, None, "a")]
    got2 = rows(cleaning.dedup_by_key(df, ["s", "d"], order_by=["t"]))
    assert got2 == [("A", 1, 1.0, "y"), ("B", 2, 5.0, "q"), ("C", 3, None, "a")]


def test_jobs_keep_the_complete_one_of_two_rows_with_a_key(spark):
    import datetime as dt
    day = dt.date(2020, 1, 1)
    weather = _weather(spark, [("1", "A", day, "Winter", 10.0, 5.0, 15.0, 3.0), ("1", "A", day, "Winter", 10.0, 5.0, 15.0, None)])
    valid, _ = jobs.clean_weather(weather, ["1"], spec=jobs.weather_spec(min_rows=1))
    assert [r["precipitation_mm"] for r in valid.collect()] == [3.0]
    co2 = spark.createDataFrame([("Aland", day, "Power", 7.0), ("Aland", day, "Power", None), ("Aland", day, "Industry", 100.0),
                                 ("Aland", day, "Ships", 100.0)],
                                "country string, date date, sector string, MtCO2_per_day double")
    valid, _ = jobs.clean_co2(co2, ["Aland"])
    assert {r["sector"]: r["MtCO2_per_day"] for r in valid.collect()} == {"Power": 7.0, "Industry": 100.0, "Ships": 100.0}


def test_statistics_are_read_again_when_a_file_is_added(spark):
    import datetime as dt
    import shutil
    import tempfile
    base = tempfile.mkdtemp(prefix="grow-")

    def write(data, name):
        _weather(spark, data).coalesce(1).write.parquet(f"{base}/{name}")

    def day(month, rain):
        return ("1", "A", dt.date(2020, month, 1), "Winter", 10.0, 5.0, 15.0, rain)

    def spi():
        spark.catalog.refreshByPath(f"{base}/all")
        df = spark.read.schema(_weather(spark, []).schema).parquet(f"{base}/all")
        return sorted(r["spi_index"] for r in enrich.add_spi_index(df).collect()), df

    write([day(1, 1.0), day(2, 2.0)], "all")
    assert spi()[0] == [-0.7, 0.7]
    write([day(3, 5.0)], "more")
    for f in os.listdir(f"{base}/more"):
        if f.endswith(".parquet"):
            shutil.copy(f"{base}/more/{f}", f"{base}/all/")      # another process appends a file
    values, df = spi()
    assert values == [-0.8, -0.3, 1.1]
    filled = impute.impute_temperatures(df.withColumn("avg_temp_c", F.when(F.month("date") < 3, F.col("avg_temp_c"))))
    assert filled.count() == 3
    result = validate.validate(df, jobs.weather_spec(min_rows=1), spark.createDataFrame([(1,)], "station_id int"))
    assert result.summary()["count.final_count"] == 3


def test_exact_median_does_not_depend_on_accuracy(spark):
    values = [float((i * 7919) % 1009) for i in range(3000)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    want = sorted(v for v in values if v is not None)[(3000 + 1) // 2 - 1]
    assert {impute.exact_median(df, "v", accuracy) for accuracy in (20, 100, 10000)} == {want}
    assert impute.exact_median(df.filter("v IS NULL"), "v") is None
    assert impute.exact_median(spark.createDataFrame([(1.0,)] * 500, "v double"), "v", 10) == 1.0


@pytest.mark.parametrize("n", [29, 87, 149])
def test_exact_median_asks_for_its_rank(spark, n):
    df = spark.createDataFrame([(float(k),) for k in range(1, n + 1)], "v double")
    assert impute.exact_median(df, "v") == (n + 1) // 2


def test_exact_median_of_bracketed_ranks(spark):
    rng = random.Random(3)
    for n in (487, 730, 1111, 2903):
        values = rng.sample(range(10 ** 6), n)
        df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
        for accuracy in (29, 87, 149):
            assert impute.exact_median(df, "v", accuracy) == sorted(values)[(n + 1) // 2 - 1], (n, accuracy)


def test_exact_median_between_two_frequent_values(spark):
    df = spark.createDataFrame([(0.0,)] * 300 + [(1.0,)] * 300, "v double")
    assert impute.exact_median(df, "v", 10) == 0.0
    assert impute.exact_median(df.union(df.filter("v = 1")), "v", 10) == 1.0


def test_group_medians_do_not_depend_on_group_size(spark):
    hot = spark.range(30001).select(F.when(F.col("id") < 0, "").alias("g"), ((F.col("id") * 7919) % 30011).cast("double").alias("v"))
    small = [("a", v) for v in (1.0, 2.0, 3.0, None)] + [("b", 5.0)] * 4 + [("b", 6.0)] * 4 + [("c", None)]
    df = hot.union(spark.createDataFrame(small, "g string, v double")).repartition(4)
    values = sorted((k * 7919) % 30011 for k in range(30001))
    want = {None: values[15000], "a": 2.0, "b": 5.0, "c": None}
    for accuracy in (100, impute.DEFAULT_ACCURACY):
        stats = impute.group_stats(df, ["g"], median_cols=["v"], accuracy=accuracy).collect()
        assert len(stats) == 4 and {r["g"]: r["__v_median"] for r in stats} == want


def test_mode_is_counted_over_the_shuffle(spark):
    df = spark.createDataFrame([("b", 1), ("b", 1), ("a", 1), ("a", 1), ("c", 1), (None, 2), (None, 3)], "s string, k int")
    out = impute.mode_fill(df.withColumn("t", F.lit(None).cast("string")), ["s", "t"])
    assert rows(out.filter("k > 1"), "s", "k", "t") == [("a", 2, None), ("a", 3, None)]
    assert "mode(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_exact_sums_fall_back_to_doubles_for_values_outside_the_type(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", 1e27), ("b", 1.0), ("c", float("nan")), ("c", 2.0), ("d", None)],
                               "k string, v double")
    got = {r["k"]: (r["s"], r["a"]) for r in df.groupBy("k").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).collect()}
    assert got["a"] == (0.3, 0.15) and got["b"][0] == 1e27 and got["d"] == (None, None)
    assert got["c"][0] != got["c"][0] and got["c"][1] != got["c"][1]


def test_fanout_total_keeps_twelve_decimals(spark):
    import datetime as dt
    day = dt.date(2020, 1, 1)
    w = spark.createDataFrame([("1", day, 1.0)] * 3, "station_id string, date date, avg_temp_c double")
    cities = spark.createDataFrame([("1", "A", "FR")], "station_id string, city_name string, iso3 string")
    countries = spark.createDataFrame([("France", "FR")], "country string, iso3 string")
    co2 = spark.createDataFrame([("France", day, 1.234e-7)], "country string, date date, MtCO2_per_day double")
    assert [r["daily_total_co2"] for r in cq.daily_temp_co2(w, cities, countries, co2).collect()] == [3.702e-7]


def test_number_columns_beyond_the_integer_range_become_null(spark):
    df = spark.createDataFrame([(3e12,), (4.0,)], "n double")
    assert rows(cleaning.scrub_columns(df, integer=["n"])) == [(None,), (4,)]


def test_text_reference_keys_meet_number_columns(spark):
    df = spark.createDataFrame([(1,), (2,)], "station_id int")
    ref = spark.createDataFrame([("1",), ("D1051",)], "station_id string")
    assert rows(semi_join_reference(df, ref, "station_id")) == [(1,)]


def test_semi_join_reference(spark):
    df = spark.createDataFrame([("1",), ("2",), ("9",), (None,)], "station_id string")
    ref = spark.createDataFrame([("1",), ("2",), ("2",)], "station_id string")
    assert rows(semi_join_reference(df, ref, "station_id")) == [("1",), ("2",)]
    assert rows(semi_join_reference(df, ["2"], "station_id")) == [("2",)]


def _weather(spark, data):
    return spark.createDataFrame(data, "station_id string, city_name string, date date, season string, "
                                       "avg_temp_c double, min_temp_c double, max_temp_c double, "
                                       "precipitation_mm double")


def test_validation_counts_first_failed_rule_once(spark):
    import datetime as dt
    d = dt.date(2020, 1, 1)
    data = [
        ("1", "A", d, "Winter", 10.0, 5.0, 15.0, 1.0),        # valid
        ("1", "A", d, "Winter", 10.0, 5.0, 15.0, 1.0),        # duplicate key
        (None, "A", d, "Winter", 10.0, 5.0, 15.0, 1.0),       # null key
        ("2", "B", d, "Winter", 70.0, 80.0, 90.0, -1.0),      # breaks order, range and precipitation
        ("3", "C", d, "Winter", 65.0, 60.0, 70.0, 1.0),       # range only
        ("4", "D", d, "Winter", 10.0, 5.0, 15.0, -2.0),       # precipitation only
        ("99", "X", d, "Winter", 10.0, 5.0, 15.0, 1.0),       # unknown station
    ]
    ref = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "station_id string")
    spec = jobs.weather_spec(min_rows=1)
    result = validate.validate(_weather(spark, data), spec, ref)
    s = result.check_gates()
    assert s["count.initial_count"] == 7
    assert s["issue.null_keys"] == 1
    assert s["issue.duplicates"] == 1
    assert s["issue.temperature_logic"] == 1       # counted once, under the first rule
    assert s["issue.temperature_range"] == 1
    assert s["issue.negative_precipitation"] == 1
    assert s["issue.referential_integrity"] == 1
    assert s["count.final_count"] == 1
    assert s["null_count.station_id"] == 1
    assert rows(result.valid, "station_id") == [("1",)]
    assert result.warnings                           # drop ratio far above 2 %
    assert result.issues_found() == {"duplicates": 1, "referential_integrity": 1}


def test_validation_gate_raises(spark):
    import datetime as dt
    data = [("1", "A", dt.date(2020, 1, 1), "Winter", 10.0, 5.0, 15.0, 1.0)]
    result = validate.validate(_weather(spark, data), jobs.weather_spec(min_rows=100), None)
    with pytest.raises(ValueError, match="too few valid rows"):
        result.check_gates()


def test_validation_schema_check(spark):
    df = spark.createDataFrame([(1,)], "station_id int")
    with pytest.raises(ValueError, match="columns not found"):
        validate.validate(df, jobs.weather_spec(), None)


def test_co2_rules_dates_and_labels(spark):
    import datetime as dt
    df = spark.createDataFrame([
        ("China", dt.date(2020, 5, 1), "Power", 1.0),
        ("China", dt.date(2030, 5, 1), "Power", 1.0),    # future
        ("China", dt.date(2018, 5, 1), "Power", 1.0),    # before the floor
        ("China", dt.date(2020, 5, 2), "", 1.0),         # empty sector
        ("China", dt.date(2020, 5, 3), "Power", -1.0),   # negative
        ("China", dt.date(2020, 5, 4), "Power", 2000.0),  # unrealistic
        ("Narnia", dt.date(2020, 5, 5), "Power", 1.0),   # unknown country
    ], "country string, date date, sector string, MtCO2_per_day double")
    spec = jobs.co2_spec(as_of="2025-01-01", min_rows=1)
    result = validate.validate(df, spec, ["China"], metrics=validate.co2_report_metrics())
    s = result.check_gates()
    for item in ["negative_emissions", "unrealistic_emissions", "empty_country_sector",
                 "referential_integrity"]:
        assert s[f"issue.{item}"] == 1, item
    assert s["issue.invalid_dates"] == 2
    assert s["count.final_count"] == 1
    assert s["metric.countries"] == 1
    assert any("countries" in w for w in result.warnings)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = rows(validate.null_profile(df))
    assert got == [("a", 1, 3, 66.67), ("b", 2, 3, 33.33)]


def test_temp_order_filter(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (3.0, 2.0, 1.0), (None, 2.0, 1.0), (2.0, 2.0, 2.0)],
                               "min_temp_c double, avg_temp_c double, max_temp_c double")
    assert len(cleaning.filter_temp_order(df).collect()) == 3


def test_weather_job_end_to_end(spark):
    import datetime as dt
    data = []
    for st in ("1", "2"):
        for day in range(1, 61):
            d = dt.date(2020, 1, 1) + dt.timedelta(days=day)
            avg = None if day % 7 == 0 else 10.0 + day % 5
            data.append((st, f" city-{st} ", d.isoformat(), "winter_1", avg, 5.0, 20.0, float(day % 9),
                         1.0, 2.0, 3.0, 4.0, 5.0, 6.0))
    raw = spark.createDataFrame(data, "station_id string, city_name string, date string, season string, "
                                      "avg_temp_c double, min_temp_c double, max_temp_c double, "
                                      "precipitation_mm double, snow_depth_mm double, avg_wind_dir_deg double, "
                                      "avg_wind_speed_kmh double, peak_wind_gust_kmh double, "
                                      "avg_sea_level_pres_hpa double, sunshine_total_min double")
    ref = spark.createDataFrame([("1",), ("2",)], "station_id string")
    valid, result = jobs.clean_weather(raw, ref)
    s = result.check_gates()
    assert s["count.final_count"] == 120
    out = valid.collect()
    assert {r["city_name"] for r in out} == {"City-1", "City-2"}
    assert {r["season"] for r in out} == {"Winter"}
    assert all(r["avg_temp_c"] is not None for r in out)
    assert "snow_depth_mm" not in valid.columns
    assert all(0 <= r["climate_risk_score"] <= 3 for r in out)
    assert isinstance(out[0]["date"], dt.date)


def test_co2_job_end_to_end(spark):
    data = [(" china ", "05/01/2020", "power", 1.5), ("china", "2020-01-06", "Aviation", None),
            ("china", "bad", "power", 2.0), ("india", "07012020", "Residential", 3.0)]
    raw = spark.createDataFrame(data, "country string, date string, sector string, MtCO2_per_day double")
    countries = spark.createDataFrame([("China",), ("India",)], "country string")
    valid, result = jobs.clean_co2(raw, countries, spec=jobs.co2_spec(as_of="2025-01-01", min_rows=1))
    got = rows(valid, "country", "sector", "MtCO2_per_day", "sector_category", "emission_level")
    # the median (2.0) is taken before the unparseable date drops out in validation
    assert got == [("China", "Aviation", 2.0, "Transportation", "Medium"),
                   ("China", "Power", 1.5, "Energy", "Medium"),
                   ("India", "Residential", 3.0, "Buildings", "Medium")]
    assert result.summary()["issue.null_keys"] == 1     # "bad" date


def test_step_counts_are_observed(spark):
    import datetime as dt
    data = [("1", "A", "2020-01-01", "w", 10.0, 5.0, 15.0, 1.0), ("1", "A", "2020-01-01", "w", 10.0, 5.0, 15.0, 1.0),
            ("1", "A", "2020-01-02", "w", 10.0, 20.0, 15.0, 1.0), ("1", None, "2020-01-03", "w", 1.0, 0.0, 2.0, 1.0)]
    raw = spark.createDataFrame(data, "station_id string, city_name string, date string, season string, "
                                      "avg_temp_c double, min_temp_c double, max_temp_c double, precipitation_mm double")
    valid, result = jobs.clean_weather(raw, None, spec=jobs.weather_spec(min_rows=1))
    valid.count()
    assert jobs.step_counts(result.steps) == {
        "weather_input": 4, "weather_after_order_filter": 3, "weather_after_dedup": 2,
        "weather_after_null_drop": 1}


def test_validation_dedup_skipped_only_when_provably_unique(spark):
    from aeris.plans.cleaning import WEATHER_CONFIG, _dedup_survives_standardizing
    spec = jobs.weather_spec()
    typed = spark.createDataFrame([("1", dt_date())], "station_id string, date date")
    text = spark.createDataFrame([("1", "2020-01-01")], "station_id string, date string")
    assert _dedup_survives_standardizing(typed, WEATHER_CONFIG, spec)
    assert not _dedup_survives_standardizing(text, WEATHER_CONFIG, spec)


def dt_date():
    import datetime as dt
    return dt.date(2020, 1, 1)
