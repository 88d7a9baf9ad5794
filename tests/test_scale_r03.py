"""Work that must not grow with one task, one wide row or one more read (findings of the third round)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from aeris.operators import compare, graph
from aeris.plans import cleaning, registry
from aeris.sources import keyed_table, readers
from tests.conftest import rows


def parquet_files(path):
    return [f for f in os.listdir(path) if f.endswith(".parquet")]


def test_file_cap_gives_way_to_size(spark, tmp_path, monkeypatch):
    csv, out = str(tmp_path / "raw.csv"), str(tmp_path / "out")
    spark.range(4000).selectExpr("id", "concat('row ', id) AS v").repartition(6).write.option("header", "true").csv(csv)
    df = readers.read_any(spark, csv, "id long, v string").repartition(6)
    cleaning.write_cleaned(df, out, files=2)
    assert len(parquet_files(out)) == 2
    size = readers.input_bytes(df)
    assert size == sum(os.stat(os.path.join(csv, f)).st_size for f in os.listdir(csv) if f.endswith(".csv"))
    monkeypatch.setattr(cleaning, "BYTES_PER_FILE", size // 5, raising=False)
    cleaning.write_cleaned(df, out, files=2)
    assert len(parquet_files(out)) >= 5
    assert spark.read.parquet(out).count() == 4000


def small_tables(spark, path):
    day = dt.datetime(1997, 3, 1)
    spark.createDataFrame([(k, k % 9, k % 4, k % 5, float(k % 50), 9.0, 0.01 * (k % 10), 0.01 * (k % 8), "RNA"[k % 3], "O", day + dt.timedelta(days=k % 60))
                           for k in range(1, 300)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
                          ).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(k, f"Supplier#{k:09d}", k % 2, 1.0) for k in range(4)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
                          ).write.parquet(f"{path}/supplier.parquet")
    spark.createDataFrame([(k, f"NATION_{k}", 0) for k in range(2)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{path}/nation.parquet")


def test_stream_loads_have_files_by_size(spark, tmp_path, monkeypatch):
    small_tables(spark, str(tmp_path))
    scratch = iter(range(9))
    monkeypatch.setattr(registry, "scratch_path", lambda _, name: str(tmp_path / f"{name}-{next(scratch)}"))
    want = rows(registry.q_stream_state(spark, str(tmp_path)))
    assert sum(r[-1] for r in want) == 299
    monkeypatch.setattr(registry, "BYTES_PER_LOAD_FILE", 1000, raising=False)
    assert rows(registry.q_stream_state(spark, str(tmp_path))) == want
    assert len(parquet_files(tmp_path / "state-0" / "weather")) == 3 and len(parquet_files(tmp_path / "state-1" / "weather")) > 6
    for k in range(2):
        assert len([f for f in os.listdir(tmp_path / f"state-{k}" / "checkpoint" / "commits") if f.isdigit()]) == 3


def test_edges_that_are_all_key_need_no_digest(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "edges")
    first = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "x string, n int")
    second = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 2), (None, None)], "x string, n int")
    graph.link_edges(first, path, ["x", "n"], buckets=2)
    graph.link_edges(second, path, ["x", "n"])
    want = rows(first.unionByName(second).distinct())
    assert rows(keyed_table.read(spark, path)) == want
    m = keyed_table.manifest(spark, path)
    stored = keyed_table._rows(spark, path, m)
    assert stored.filter(F.col(keyed_table.DIGEST).isNotNull()).isEmpty()
    graph.link_edges(second.unionByName(first), path, ["x", "n"])
    assert keyed_table.manifest(spark, path).version == m.version   # all there
    old = str(tmp_path / "old")   # a table whose rows have digests goes on
    with monkeypatch.context() as c:
        c.setattr(keyed_table, "_same_if_equal", lambda _: False)
        keyed_table.upsert(first, old, ["x", "n"], buckets=2)
    keyed_table.upsert(second, old, ["x", "n"])
    assert rows(keyed_table.read(spark, old)) == want
    zero = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),)], "x double")
    keyed_table.upsert(zero, str(tmp_path / "zero"), ["x"], buckets=2)
    assert keyed_table.read(spark, str(tmp_path / "zero")).count() == 2


def test_merged_edges(spark):
    w = spark.createDataFrame([("s", dt.date(2020, 1, 1), 1.0), ("s", dt.date(2020, 1, 1), 2.0), ("s", dt.date(2020, 1, 1), 2.0), ("s", None, 1.0)],
                              "station_id string, date date, v double")
    assert rows(graph.on_date(w, keys=["station_id"])) == [("s", "2020-01-01")] * 2
    assert rows(graph.on_date(w, keys=["station_id"], merge_edges=True)) == [("s", "2020-01-01")]


def test_comparison_reads_each_table_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        seen.add(1)
        return v

    before = spark.range(60).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).alias("k"))
    after = before.filter("x < 30").select(counted("x").alias("x"), "k")
    got = {r["column_name"]: r for r in compare.compare(before, after, ["x", "k"], bins=3).collect()}
    assert seen.value == 30
    assert got["x"]["histogram_after"] == [20, 10, 0] and got["k"]["histogram_before"] == [20, 20, 20]
    assert (got["k"]["distinct_before"], got["x"]["distinct_after"]) == (3, 30)


def joins(plan, column):
    """Join nodes of a logical plan that put out ``column``."""
    here = plan.nodeName() == "Join" and any(plan.output().apply(i).name() == column for i in range(plan.output().size()))
    return here + sum(joins(plan.children().apply(i), column) for i in range(plan.children().size()))


def test_weather_job_joins_its_rows_once(spark):
    day = dt.date(2020, 1, 1)
    raw = spark.createDataFrame([(f"s{k % 3}", "c", day + dt.timedelta(days=k), "winter", 1.0, 0.0, None if k % 5 else 2.0, 1.0 * (k % 4)) for k in range(40)],
                                "station_id string, city_name string, date date, season string, avg_temp_c double, min_temp_c double, "
                                "max_temp_c double, precipitation_mm double")
    stations = spark.createDataFrame([("s0",), ("s1",), (None,)], "station_id string")
    valid, result = cleaning.clean_weather(raw, stations)
    assert {r[0] for r in valid.select("station_id").collect()} == {"s0", "s1"} and "__ref_hit" not in valid.columns
    assert joins(valid._jdf.queryExecution().optimizedPlan(), "city_name") == 1
    s = result.summary()
    assert s["issue.referential_integrity"] == 13 and s["count.final_count"] == 27 and not any("__ref" in k for k in s)
    twice, other = cleaning.clean_weather(raw, stations, fuse_statistics=False)
    assert rows(twice.drop("processing_time")) == rows(valid.drop("processing_time")) and other.summary() == s
