"""Gates on micro-batches, duplicates in flight, the stored state of the vulnerability stream."""

import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from aeris.operators.validate import Rule
from aeris.plans.vulnerability import country_vulnerability
from aeris.streaming import gates, ingest
from aeris.streaming import vulnerability_stream as vs
from tests.conftest import rows


def put(folder, name, lines, order):
    folder.mkdir(exist_ok=True)
    f = folder / name
    f.write_text("\n".join(lines) + "\n")
    os.utime(f, (1_600_000_000 + order, 1_600_000_000 + order))


def line(k, v, ts="2020-01-01T00:00:00.000000Z"):
    return json.dumps({"id": k, "v": v, "ts": ts})


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], "id long, v double, ts timestamp").schema


def gate(**kw):
    return gates.Gate(keys=["id"], rules=[Rule("negative", lambda: F.col("v") >= 0)], **{"min_rows": 2, "max_bad_ratio": 0.3, **kw})


def test_bad_batch_is_diverted_and_reported(spark, schema, tmp_path):
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    put(src, "a", [line(1, 1.0), line(2, 2.0), line(3, -1.0), line(4, 4.0)], 0)          # one of four: admitted
    put(src, "b", [line(5, 1.0), "junk", line(None, 1.0), "[1]"], 1)                      # three of four: diverted
    put(src, "c", [line(6, 1.0)], 2)                                                      # too few rows: diverted
    q = gates.gated_ingest(spark, str(src), sink, str(tmp_path / "ck"), schema, gate(), max_per_trigger=1)
    ingest.await_query(q)
    assert rows(ingest.ingested(spark, sink, schema), "id") == [(1,), (2,), (4,)]
    assert rows(gates.quarantined(spark, sink)) == sorted(
        [(line(3, -1.0), "negative"), (line(5, 1.0), None), ("junk", "payload"), (line(None, 1.0), "key"), ("[1]", "payload"), (line(6, 1.0), None)],
        key=lambda t: tuple((v is not None, str(v)) for v in t))
    report = {r["batch_id"]: r for r in gates.gate_report(spark, sink).collect()}
    assert [(r["rows"], r["bad_payloads"], r["null_keys"], r["rule_failures"], r["good"], r["admitted"]) for _, r in sorted(report.items())] == [
        (4, 0, 0, {"negative": 1}, 3, True), (4, 2, 1, {"negative": 0}, 1, False), (1, 0, 0, {"negative": 0}, 1, False)]


def test_replayed_batch_changes_nothing(spark, schema, tmp_path):
    src, sink, check = tmp_path / "src", str(tmp_path / "sink"), tmp_path / "ck"
    put(src, "a", [line(1, 1.0), line(2, 2.0)], 0)
    ingest.await_query(gates.gated_ingest(spark, str(src), sink, str(check), schema, gate()))
    before = rows(gates.gate_report(spark, sink))
    shutil.rmtree(check / "commits")  # as if the driver had gone before the commit
    ingest.await_query(gates.gated_ingest(spark, str(src), sink, str(check), schema, gate()))
    assert rows(ingest.ingested(spark, sink, schema), "id") == [(1,), (2,)] and rows(gates.gate_report(spark, sink)) == before


def test_listener_counts_batches_and_stops_at_a_broken_gate(spark, schema, tmp_path):
    src = tmp_path / "src"
    put(src, "a", [line(k, 1.0) for k in range(5)], 0)
    put(src, "b", [line(k, -1.0) for k in range(5)], 1)
    stopped = []
    listener = gates.GateListener("gate", gate(), stopped.append)
    spark.streams.addListener(listener)
    try:
        rows_ = ingest.accepted(ingest.decode(ingest.read_events(spark, str(src), max_per_trigger=1), schema))
        q = gates.watched(rows_, "gate", gate()).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(
            availableNow=True).start()
        ingest.await_query(q)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert [(n, good, ok) for _, n, good, ok in listener.seen] == [(5, 5, True), (5, 0, False)]
    assert stopped == [str(q.id)]


def test_duplicates_in_flight(spark, schema, tmp_path):
    """Repeats within an hour go, a key comes back after that; the state shrinks as the watermark passes."""
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    start = dt.datetime(2020, 1, 1)

    def at(minutes):
        return (start + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.000000Z")

    put(src, "a", [line(k, 1.0, at(k)) for k in range(10)] + [line(3, 9.0, at(4))], 0)
    put(src, "b", [line(k, 2.0, at(k + 20)) for k in range(10)] + ["junk"], 1)            # replayed within the hour
    put(src, "c", [line(100, 3.0, at(600))], 2)                                           # the watermark moves on
    put(src, "d", [line(101, 4.0, at(601))], 3)                                           # old keys are forgotten
    put(src, "e", [line(5, 4.0, at(602)), line(77, 4.0, at(1))], 4)                       # 5 is new again, 77 is too late
    q = ingest.ingest_unique(spark, str(src), sink, str(tmp_path / "ck"), schema, ["id"], "ts", "60 minutes", max_per_trigger=1)
    ingest.await_query(q)
    got = spark.read.schema(schema).parquet(sink)
    assert sorted(r["id"] for r in got.collect()) == sorted([*range(10), 100, 101, 5])
    assert {r["v"] for r in got.filter("id < 10 AND ts < '2020-01-01 05:00:00'").collect()} <= {1.0, 9.0}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in (json.loads(p.json) for p in q.recentProgress) if p["stateOperators"]]
    assert max(held) >= 10 and held[-1] <= 3


@pytest.mark.parametrize("rocksdb", [False, True])
def test_stored_state_equals_the_batch_and_survives_a_restart(spark, tmp_path, rocksdb):
    data = [(f"s{k}", f"City{k % 4}", f"2020-01-{k % 28 + 1:02}", k % 30 / 10, ["LOW", "MODERATE", "HIGH", "CRITICAL"][k % 4]) for k in range(60)]
    weather = spark.createDataFrame(data, "station_id string, city_name string, date string, climate_risk_score double, climate_risk_level string")
    cities = spark.createDataFrame([(f"s{k}", f"City{k}", "AB"[k % 2]) for k in range(3)], "station_id string, city_name string, country string")
    path, check = str(tmp_path / "w"), str(tmp_path / "ck")
    settings = {**vs.STREAM_CONF, **(vs.ROCKSDB_CONF if rocksdb else {})}
    before = {k: spark.conf.get(k, None) for k in settings}
    vs.configure_stream_session(spark, settings)
    assert all(spark.conf.get(k) == v for k, v in settings.items())  # T4
    try:
        for part in ("k < 40", "k >= 40"):  # the second run starts from the checkpoint of the first
            numbered = weather.withColumn("k", F.substring("station_id", 2, 9).cast("int"))
            numbered.filter(part).drop("k").coalesce(1).write.mode("append").parquet(path)
            q = vs.start(vs.vulnerability_plan(spark, path, cities, schema=weather.schema), sink="table", path=str(tmp_path / "t"), checkpoint=check,
                         available_now=True)
            q.awaitTermination()
            assert q.exception() is None
            want = country_vulnerability(numbered.filter(part if part == "k < 40" else "true").drop("k"), cities)
            cols = ["country", "max_risk_score", "min_risk_score", "low_cnt", "moderate_cnt", "high_cnt", "critical_cnt", "events"]
            assert rows(vs.stored_state(spark, check), *cols) == rows(want, *cols)
        first = vs.stored_state(spark, check, batch_id=0).agg(F.sum("events")).first()[0]
        assert first == 40
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
