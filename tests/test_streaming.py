import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from aeris.plans.vulnerability import country_vulnerability
from aeris.streaming import ingest, vulnerability_stream
from tests.conftest import rows

SCHEMA = StructType([StructField("country", StringType()), StructField("date", StringType()),
                     StructField("sector", StringType()), StructField("MtCO2_per_day", DoubleType())])


def _write_lines(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_ingest_accepts_objects_and_rejects_the_rest(spark):
    base = tempfile.mkdtemp(prefix="ingest-")
    src = os.path.join(base, "src")
    os.makedirs(src)
    _write_lines(src, "a.json", [
        '{"country": "China", "date": "2020-01-01", "sector": "Power", "MtCO2_per_day": 1.5}',
        '{"country": "India", "date": "2020-01-02", "sector": null, "MtCO2_per_day": null}',
        '\t{"country": "France"} ',                       # missing keys -> nulls
    ])
    _write_lines(src, "b.json", ['[{"country": "X"}]', "null", "{not json", "", '{"country": "X"} tail', '{"country": "X"},{}'])
    ingest.await_query(ingest.ingest(spark, src, f"{base}/sink", f"{base}/ckpt", SCHEMA, max_per_trigger=1,
                                     rejects=f"{base}/rejects"))
    got = rows(ingest.ingested(spark, f"{base}/sink", SCHEMA))
    assert sorted(got, key=str) == sorted([("China", "2020-01-01", "Power", 1.5),
                                           ("India", "2020-01-02", None, None),
                                           ("France", None, None, None)], key=str)
    rejected = sorted(r["payload"] for r in ingest.refused(spark, f"{base}/rejects").collect())
    assert rejected == sorted(['[{"country": "X"}]', "null", "{not json", "", '{"country": "X"} tail', '{"country": "X"},{}'])


def test_ingest_is_exactly_once_on_rerun(spark):
    base = tempfile.mkdtemp(prefix="ingest2-")
    src = os.path.join(base, "src")
    os.makedirs(src)
    _write_lines(src, "a.json", ['{"country": "China", "date": "d", "sector": "s", "MtCO2_per_day": 1.0}'])
    for _ in range(2):     # a restart with the same checkpoint must not duplicate rows
        ingest.await_query(ingest.ingest(spark, src, f"{base}/sink", f"{base}/ckpt", SCHEMA))
    assert ingest.ingested(spark, f"{base}/sink", SCHEMA).count() == 1


def test_json_round_trip_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None, 1.0), (None, "b", None)], "x string, y string, z double")
    lines = [r[0] for r in ingest.to_json_lines(df).collect()]
    assert '"y":null' in lines[0]
    assert rows(ingest.json_round_trip(df)) == rows(df)


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="vuln-")
    cities = spark.createDataFrame([("1", "Rostov-on-Don", "Russia"), ("2", "Paris", "France")],
                                   "station_id string, city_name string, country string")
    data = [("Rostov-on-don", "2020-01-01", 2.6, "CRITICAL"), ("Paris", "2020-01-01", 0.2, "LOW"),
            ("Paris", "2020-01-02", 1.6, "HIGH"), ("Atlantis", "2020-01-01", 0.6, "MODERATE"),
            ("Paris", "2020-01-03", 0.5, "MODERATE"), ("Rostov-on-don", "2020-01-02", 0.0, "LOW")]
    schema = "city_name string, date string, climate_risk_score double, climate_risk_level string"
    for i in range(3):   # three files, one per trigger
        spark.createDataFrame(data[2 * i:2 * i + 2], schema).coalesce(1).write.mode("append").parquet(
            f"{base}/weather")
    plan = vulnerability_stream.vulnerability_plan(spark, f"{base}/weather", cities, max_files_per_trigger=1)
    q = vulnerability_stream.start(plan, sink="table", path=f"{base}/state",
                                   checkpoint=f"{base}/ckpt", available_now=True)
    q.awaitTermination()
    assert q.lastProgress["batchId"] == 2                       # three batches,
    assert sorted(d for d in os.listdir(f"{base}/state")) == ["batch_id=1", "batch_id=2"]   # two kept
    streamed = rows(vulnerability_stream.latest_state(spark, f"{base}/state"))
    batch = rows(country_vulnerability(spark.read.parquet(f"{base}/weather"), cities)
                 .select(*[F.col(c) for c in vulnerability_stream.VULNERABILITY_COLUMNS]))
    assert streamed == batch


def test_console_stream_runs_and_stops(spark):
    base = tempfile.mkdtemp(prefix="console-")
    cities = spark.createDataFrame([("1", "Paris", "France")], "station_id string, city_name string, country string")
    spark.createDataFrame([("Paris", "2020-01-01", 0.2, "LOW")],
                          "city_name string, date string, climate_risk_score double, climate_risk_level string") \
        .write.parquet(f"{base}/weather")
    q = vulnerability_stream.process_stream(spark, f"{base}/weather", cities, checkpoint=f"{base}/ckpt",
                                            trigger_seconds=1, timeout_seconds=8)
    assert not q.isActive
    assert q.lastProgress is not None
