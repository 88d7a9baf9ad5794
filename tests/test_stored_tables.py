"""Month folders, keyed tables, stored index states, profiles, radix selection, comparisons, typed CSV, JSON acceptance."""

import datetime as dt
import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from aeris import cli
from aeris.operators import compare, documents, enrich, graph, impute, profile, spi_state
from aeris.plans import climate_queries as cq
from aeris.plans.cleaning import write_cleaned
from aeris.sources import bucketed_table, keyed_table, month_table, readers
from aeris.sources.schemas import WEATHER_CLEAN_SCHEMA
from aeris.streaming import ingest
from tests.conftest import rows


def day(k):
    return dt.date(2020, 1, 1) + dt.timedelta(days=k)


def files_below(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.fixture
def weather(spark):
    return spark.createDataFrame([(f"s{k % 5}", day(k), float(k % 41), 1.0 * (k % 7)) for k in range(200)] + [("s1", None, 3.0, 1.0)],
                                 "station_id string, date date, max_temp_c double, precipitation_mm double")


# -- month folders -------------------------------------------------------------

def scans(df):
    """(partitions read, files read) of every file scan of an executed frame."""
    plan, out = df._jdf.queryExecution().executedPlan(), []
    todo = [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(p.plan())
        if name == "FileSourceScanExec":
            metrics = p.metrics()
            got = {k: metrics.apply(k).value() for k in ("numPartitions", "numFiles") if metrics.contains(k)}
            out.append((got.get("numPartitions"), got.get("numFiles"), p.toString()))
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_top_day_reads_one_month(spark, weather, tmp_path):
    path = str(tmp_path / "weather")
    write_cleaned(weather, path, by_month=True)
    assert sorted(f for f in os.listdir(path) if f.startswith("month="))[:3] == ["month=2020-01", "month=2020-02", "month=2020-03"]
    table = month_table.read_by_month(spark, path)
    assert rows(table.drop("month"), *weather.columns) == rows(weather)
    cities = spark.createDataFrame([(f"s{k}", f"c{k}", "X") for k in range(5)], "station_id string, city_name string, country string")
    co2 = spark.createDataFrame([("X", day(k), 500.0 if k == 70 else 1.0) for k in range(200)], "country string, date date, MtCO2_per_day double")
    got = cq.top_emission_day_with_cities(co2, table, cities)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString().lower()
    assert got.collect() == cq.top_emission_day_with_cities(co2, weather, cities).collect()
    assert [p for p, _, text in scans(got) if "max_temp_c" in text] == [1]


def test_month_is_written_again(spark, weather, tmp_path):
    path = str(tmp_path / "weather")
    month_table.write_by_month(weather, path)
    before = files_below(path)
    month_table.write_by_month(weather.filter("month(date) = 2").withColumn("max_temp_c", F.lit(0.0)), path)
    kept = {f: t for f, t in files_below(path).items() if "month=2020-02" not in f}
    assert kept == {f: t for f, t in before.items() if "month=2020-02" not in f}
    assert month_table.read_by_month(spark, path).filter("month = '2020-02'").agg(F.max("max_temp_c")).first()[0] == 0.0
    empty = str(tmp_path / "empty")
    month_table.write_by_month(weather.filter("false"), empty)


# -- keyed tables --------------------------------------------------------------

def test_small_change_rewrites_few_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).select(F.concat(F.lit("s"), (F.col("id") % 1000).cast("string")).alias("station_id"), F.col("id").alias("day"),
                                    F.lit(1.0).alias("v"))
    load = {"keys": ["station_id", "day"], "buckets": 200, "bucket_by": ["station_id"]}
    assert keyed_table.upsert(df, path, **load).rewritten > 190
    again = keyed_table.upsert(df, path, **load)
    assert again.version == 1  # nothing new, so no version
    before = files_below(path)
    m = keyed_table.upsert(df.withColumn("v", F.when(F.col("station_id").isin("s3", "s4"), 2.0).otherwise(F.col("v"))), path, **load)
    assert m.version == 2 and 1 <= m.rewritten <= 2
    assert before.items() <= files_below(path).items()
    assert keyed_table.read(spark, path).filter("v = 2").count() == 40
    assert keyed_table.read(spark, path, version=1).filter("v = 2").count() == 0
    keyed_table.upsert(spark.createDataFrame([("s9", 9, 7.0), ("new", 1, 7.0)], "station_id string, day long, v double"), path, ["x"])
    assert rows(keyed_table.read(spark, path).filter("v = 7")) == [("new", 1, 7.0), ("s9", 9, 7.0)]
    assert keyed_table.read(spark, path).count() == 20_001
    assert keyed_table.vacuum(spark, path, keep=1) > 0
    assert keyed_table.read(spark, path).count() == 20_001 and keyed_table.manifest(spark, path, 1) is None


def test_broken_load_is_not_seen_and_is_replayed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    second = spark.createDataFrame([(2, "B"), (3, "c"), (None, "N")], "k int, v string")
    keyed_table.upsert(first, path, ["k"], buckets=4)

    def fail(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(keyed_table, "_commit", fail)
        with pytest.raises(OSError):
            keyed_table.upsert(second, path, ["k"], batch_id="b2")
    assert rows(keyed_table.read(spark, path)) == rows(first)
    keyed_table.upsert(second, path, ["k"], batch_id="b2")
    want = [(None, "N"), (1, "a"), (2, "B"), (3, "c")]
    assert rows(keyed_table.read(spark, path)) == want
    version = keyed_table.upsert(second.withColumn("v", F.lit("z")), path, ["k"], batch_id="b2").version  # known batch
    assert version == 2 and rows(keyed_table.read(spark, path)) == want
    assert keyed_table.vacuum(spark, path) >= 1
    assert rows(keyed_table.read(spark, path)) == want
    stale = keyed_table.manifest(spark, path)
    with pytest.raises(RuntimeError):
        keyed_table._commit(spark, path, stale)  # another writer was faster


def test_same_key_twice_in_a_load_and_empty_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k int, at int, v string")
    assert keyed_table.upsert(empty, path, ["k"], buckets=3).folders == {}
    assert keyed_table.read(spark, path).count() == 0
    twice = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, None, None)], "k int, at int, v string")
    keyed_table.upsert(twice, path, ["k"], order_by="at")
    assert rows(keyed_table.read(spark, path)) == [(1, 2, "new"), (2, None, None)]
    with pytest.raises(FileNotFoundError):
        keyed_table.read(spark, path, version=99)


def test_documents_and_edges_are_there_once(spark, tmp_path):
    docs = documents.city_documents(spark.createDataFrame([("s1", "c", 1.0, 2.0), ("s2", "d", None, None)],
                                                          "station_id string, city_name string, latitude double, longitude double"))
    for _ in range(3):
        documents.upsert_documents(docs, str(tmp_path / "cities"), ["station_id"], buckets=2)
    assert keyed_table.read(spark, str(tmp_path / "cities")).count() == 2
    edges = spark.createDataFrame([("a", "b", 1), ("a", None, 2)], "x string, y string, n int")
    for shift in (0, 5):
        graph.link_edges(edges.withColumn("n", F.col("n") + shift), str(tmp_path / "edges"), ["x", "y"], buckets=2)
    assert rows(keyed_table.read(spark, str(tmp_path / "edges"))) == rows(edges)


# -- stored index states -------------------------------------------------------

@pytest.mark.parametrize("cuts", [(400,), (100, 115, 700), (1,)])
def test_index_from_states_equals_one_pass(spark, cuts):
    rng = random.Random(3)
    data = [(f"s{k % 6}" if k % 50 else None, day(k // 2) if k % 40 else None, 5.0 if k % 6 == 2 else rng.choice([None, round(rng.random() * 20, 1)]))
            for k in range(1200)]
    df = spark.createDataFrame(data, "station_id string, date date, precipitation_mm double").withColumn("_n", F.monotonically_increasing_id())
    edges = [*cuts, 10 ** 9]
    parts, low = [], 0
    numbered = spark.createDataFrame([(*d, k) for k, d in enumerate(data)], "station_id string, date date, precipitation_mm double, k int")
    for e in edges:
        parts.append(numbered.filter(f"k >= {low} AND k < {e}"))
        low = e
    months = spi_state.month_states(parts[0])
    stations = spi_state.station_states(months)
    for p in parts[1:]:
        months, stations = spi_state.update(months, stations, spi_state.month_states(p))
        months, stations = (spark.createDataFrame(x.collect(), x.schema) for x in (months, stations))
    want = enrich.spi_table(df).toDF("station_id", "year", "month", "spi_index")
    assert rows(spi_state.spi(months, stations)) == rows(want)


# -- bucketed tables -----------------------------------------------------------

def test_bucketed_tables_join_without_an_exchange(spark, weather, tmp_path):
    keyed = weather.filter("date IS NOT NULL").withColumn("month", F.date_format("date", "yyyy-MM"))
    facts = bucketed_table.write_bucketed(keyed, str(tmp_path / "facts"), 4)
    means = bucketed_table.read_bucketed(spark, facts).groupBy("station_id", "month").agg(F.avg("precipitation_mm").alias("mean"))
    assert "Exchange" not in means._jdf.queryExecution().executedPlan().toString()
    stats = bucketed_table.write_bucketed(means, str(tmp_path / "stats"), 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = bucketed_table.attach_month_stats(bucketed_table.read_bucketed(spark, facts), bucketed_table.read_bucketed(spark, stats))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = keyed.join(keyed.groupBy("station_id", "month").agg(F.avg("precipitation_mm").alias("mean")), ["station_id", "month"])
        assert rows(got, *want.columns) == rows(want)
        assert len(os.listdir(tmp_path / "facts")) <= 2 * 4 + 2  # a file (and its checksum) per bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in (facts, stats):
            spark.sql(f"DROP TABLE {t}")


# -- profiles ------------------------------------------------------------------

def test_profiles_add_up(spark):
    data = [(k if k % 3 else None, float("nan") if k % 10 == 0 else (k % 97) / 2, f"t{k % 500}", k % 2 == 0, day(k % 300), None) for k in range(6000)]
    df = spark.createDataFrame(data, "i int, x double, s string, b boolean, d date, nothing string")
    whole = {r["column_name"]: r for r in profile.profile_report(profile.column_profile(df)).collect()}
    parts = [profile.column_profile(df.filter(F.pmod(F.hash("s"), F.lit(5)) == k)) for k in range(5)] + [profile.column_profile(df.filter("false"))]
    merged = {r["column_name"]: r for r in profile.profile_report(profile.merge_profiles(*parts)).collect()}
    assert set(whole) == set(df.columns)
    for c, w in whole.items():
        m = merged[c]
        for f in ("total_rows", "null_count", "nan_count", "min_number", "max_number", "min_text", "max_text", "completeness_pct"):
            assert m[f] == w[f], (c, f)
        exact = df.agg(F.count_distinct(c)).first()[0]
        assert abs(m["distinct_estimate"] - exact) <= max(1, 0.06 * exact)
    assert merged["x"]["nan_count"] == 600 and merged["nothing"]["null_count"] == 6000 and merged["nothing"]["quantiles"] is None
    values = sorted(v for _, v, *_ in data if not math.isnan(v))
    for rank, got in zip((0.25, 0.5, 0.75), merged["x"]["quantiles"], strict=True):
        below = sum(v < got for v in values) / len(values)
        upto = sum(v <= got for v in values) / len(values)
        assert below - 0.03 <= rank <= upto + 0.03


# -- radix selection -----------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 29, 87, 1000, 50_000])
def test_median_with_nan_at_any_size(spark, n):
    df = spark.range(n).select(F.when(F.col("id") % 5 < 2, F.lit(float("nan"))).otherwise(F.col("id") % 7 - 3.0).alias("v"))
    values = sorted([(math.inf if k % 5 < 2 else k % 7 - 3.0) for k in range(n)])
    want = values[(n + 1) // 2 - 1]
    got = impute.exact_median(df, "v")
    assert math.isnan(got) if want == math.inf else got == want


def test_median_of_odd_values(spark):
    special = [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, math.inf, -math.inf, 1e-9, -1e-9, 3.5, -3.5]
    rng = random.Random(2)
    for k in range(12):
        values = [rng.choice(special) for _ in range(rng.randint(1, 40))]
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        assert impute.exact_median(df, "v") == sorted(values)[(len(values) + 1) // 2 - 1], k
    for kind, values in (("long", [2 ** 62 + 1, -(2 ** 62), 7]), ("int", [-5, 3, 9, 10]), ("decimal(10,2)", [1, 2, 3])):
        df = spark.createDataFrame([(v,) for v in values], "v long").select(F.col("v").cast(kind).alias("v"))
        assert impute.exact_median(df, "v") == sorted(values)[(len(values) + 1) // 2 - 1]
    group = spark.createDataFrame([("a", float("nan")), ("a", 1.0), ("a", 2.0), ("b", None)], "g string, v double")
    assert rows(impute.group_medians(group, ["g"], "v", 10)) == [("a", 2.0)]


# -- comparison ----------------------------------------------------------------

def test_comparison_of_columns(spark):
    before = spark.createDataFrame([(float(k), 1.0, None) for k in range(100)] + [(None, 1.0, None)], "x double, same double, none double")
    after = before.filter("x < 50")
    got = {r["column_name"]: r for r in compare.compare(before, after, ["x", "same", "none"], bins=10).collect()}
    assert got["x"]["histogram_before"] == [10] * 10 and got["x"]["histogram_after"] == [10] * 5 + [0] * 5 and got["x"]["distance"] == 0.5
    assert (got["x"]["nulls_before"], got["x"]["nulls_after"], got["x"]["distinct_after"]) == (1, 0, 50)
    assert got["same"]["distance"] == 0.0 and got["none"]["distance"] is None and got["none"]["histogram_before"] is None
    none = compare.compare(before.filter("false"), before.filter("false"), ["x"]).first()
    assert none["rows_before"] == 0 and none["distance"] is None


# -- typed CSV, JSON, batches --------------------------------------------------

def test_csv_by_name_keeps_ids_as_text(spark, tmp_path):
    path = str(tmp_path / "weather.csv")
    (tmp_path / "weather.csv").write_text("date,station_id,max_temp_c,extra\n2020-01-05,0151,40.5,7\n,D1051,,\n")
    got = readers.read_any(spark, path, known=WEATHER_CLEAN_SCHEMA)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("date", "date"), ("station_id", "string"), ("max_temp_c", "double"), ("extra", "string")]
    assert rows(got) == [(None, "D1051", None, None), (dt.date(2020, 1, 5), "0151", 40.5, "7")]


def test_extreme_query_on_csv(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    w = put("w.csv", "station_id,date,max_temp_c,climate_risk_score,climate_risk_level\n11,2020-01-05,40.5,1.5,HIGH\n12,2020-01-05,41.5,1.5,HIGH\n")
    c = put("c.csv", "country,date,sector,MtCO2_per_day\nX,2020-01-05,Power,3.5\n")
    cities = put("cities.csv", "station_id,city_name,country,state,iso2,iso3,latitude,longitude\n11,a,X,,,,1,1\nD1051,b,X,,,,1,1\n")
    cli.run(spark, ["query", "extreme", "--weather", w, "--co2", c, "--cities", cities, "--output", str(tmp_path / "out")])
    got = spark.read.parquet(str(tmp_path / "out" / "extreme"))
    assert rows(got, "country", "extreme_events", "max_temp") == [("X", 1, 40.5)]


def test_only_one_object_is_accepted(spark):
    bad = ['{"a":1}] junk', '{"a":1}]', '{"a":1}}', '{"a":1}} junk {', '{"a":1}, {"a":2}', '{"a":1}, "y": 2', '{"a":1},', '{"a":1} x', "[1]", "null", "",
           '{"a":1}], [{"a":1}', '{"a":1}}, {"y":{']
    good = ['{"a":1}', ' {"a":1} \t', '{"a":{"b":[1,2]}}', '{}', '{"a":"]}{"}']
    raw = spark.createDataFrame([(t,) for t in [*bad, *good, None]], "value string")
    schema = spark.createDataFrame([], "a string").schema
    got = {r["__raw"]: r["_is_object"] for r in ingest.decode(raw, schema).collect()}
    assert {t for t, ok in got.items() if ok} == set(good)


def test_batches_by_volume_and_finished_ones_only(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for k, n in enumerate([400, 400, 400, 50, 50, 50, 50, 3000, 10, 10]):
        f = src / f"f{k}.json"
        f.write_text("\n".join(json.dumps({"event_id": i, "pad": "x" * 20}) for i in range(n)) + "\n")
        os.utime(f, (1_600_000_000 + k, 1_600_000_000 + k))
    schema = spark.createDataFrame([], "event_id long, pad string").schema
    sink = str(tmp_path / "sink")
    q = ingest.ingest(spark, str(src), sink, str(tmp_path / "ck"), schema, max_bytes_per_trigger=40_000, files_per_batch=1)
    ingest.await_query(q)
    batches = ingest.finished_batches(spark, sink)
    assert 4 <= len(batches) < 10
    for b in batches:
        assert len([f for f in os.listdir(b.removeprefix("file:")) if f.endswith(".parquet")]) == 1
    whole = ingest.ingested(spark, sink, schema).count()
    assert whole == 4420
    half = tmp_path / "sink" / "batch_id=99"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"cut short")
    assert ingest.ingested(spark, sink, schema).count() == whole
    assert ingest.ingested(spark, str(tmp_path / "none"), schema).count() == 0 and ingest.refused(spark, str(tmp_path / "none")).count() == 0
