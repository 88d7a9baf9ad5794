"""Quality gates while data arrives (V4-V10 on a stream).

``gated_ingest`` looks at every micro-batch before its rows are let in: payloads that are not an object, null keys and
failed rules are counted in one aggregate.  A batch with too few good rows, or too large a
share of bad ones, is diverted whole to the quarantine; of the others the bad rows are.  What was found, and where
the batch went, is a row of the report table.  Every batch writes folders of its own, so a replay writes the same
again.  ``GateListener`` watches metrics that a streaming plan observes and stops its query when a gate is broken, for
streams that have no batch function.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from aeris.operators.validate import Rule, flag_rules
from aeris.streaming.ingest import decode, finished_batches, read_events

REPORT_SCHEMA = "batch_id long, rows long, bad_payloads long, null_keys long, rule_failures map<string,long>, good long, admitted boolean"


@dataclass
class Gate:
    """A batch passes with ``min_rows`` good rows at least and a share of ``max_bad_ratio`` bad ones at most."""

    keys: Sequence[str] = ()
    rules: Sequence[Rule] = field(default_factory=list)
    min_rows: int = 1
    max_bad_ratio: float = 0.05

    def admits(self, rows: int, good: int) -> bool:
        return good >= self.min_rows and (rows - good) <= self.max_bad_ratio * rows


def _judged(decoded: DataFrame, gate: Gate) -> DataFrame:
    """Decoded rows with ``_fault``: what is wrong with a row, null if nothing is."""
    flagged = flag_rules(decoded, gate.rules)
    key_missing = F.lit(False)
    for k in gate.keys:
        key_missing = key_missing | F.col(k).isNull()
    fault = F.when(~F.col("_is_object"), "payload").when(key_missing, "key").otherwise(F.col("first_failed_rule"))
    return flagged.withColumn("_fault", fault).drop("first_failed_rule", "_is_object")


def gated_ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: StructType, gate: Gate,
                 max_per_trigger: int | None = None, available_now: bool = True, processing_time: str = "1 second") -> StreamingQuery:
    """Start the query; good rows of admitted batches go below ``sink``, the rest below ``<sink>_quarantine``, a row per batch
    below ``<sink>_report``."""
    quarantine, report = f"{sink.rstrip('/')}_quarantine", f"{sink.rstrip('/')}_report"
    judged = _judged(decode(read_events(spark, source, max_per_trigger=max_per_trigger), schema), gate)

    def write(batch: DataFrame, batch_id: int) -> None:
        fault = F.col("_fault")
        found = batch.agg(F.count(F.lit(1)).alias("rows"), F.count_if(fault == "payload").alias("payload"), F.count_if(fault == "key").alias("key"),
                          *[F.count_if(fault == r.name).alias(f"rule_{i}") for i, r in enumerate(gate.rules)],
                          F.count_if(fault.isNull()).alias("good")).first()
        admitted = gate.admits(found["rows"], found["good"])
        good = batch.filter(fault.isNull() & F.lit(admitted)).drop("_fault", "__raw")
        good.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        away = batch.filter(fault.isNotNull() | F.lit(not admitted)).select(F.col("__raw").alias("payload"), fault.alias("fault"))
        away.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        failures = {r.name: found[f"rule_{i}"] for i, r in enumerate(gate.rules)}
        row = (batch_id, found["rows"], found["payload"], found["key"], failures, found["good"], admitted)
        batch.sparkSession.createDataFrame([row], REPORT_SCHEMA).write.mode("overwrite").parquet(f"{report}/batch_id={batch_id}")

    writer = judged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()


def quarantined(spark: SparkSession, sink: str) -> DataFrame:
    """(payload, fault) of what was diverted; fault is null for good rows of a batch that was not admitted."""
    done = finished_batches(spark, f"{sink.rstrip('/')}_quarantine")
    schema = "payload string, fault string"
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)


def gate_report(spark: SparkSession, sink: str) -> DataFrame:
    done = finished_batches(spark, f"{sink.rstrip('/')}_report")
    return spark.read.schema(REPORT_SCHEMA).parquet(*done) if done else spark.createDataFrame([], REPORT_SCHEMA)


def watched(df: DataFrame, name: str, gate: Gate) -> DataFrame:
    """``df`` with the counts of ``gate`` observed under ``name``, without a job of their own."""
    fails = F.lit(False)
    for k in gate.keys:
        fails = fails | F.col(k).isNull()
    for r in gate.rules:
        fails = fails | ~F.coalesce(r.keep(), F.lit(False))
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(~fails).alias("good"))


class GateListener(StreamingQueryListener):
    """Keeps the observed counts of each batch and stops the query whose batch breaks the gate."""

    def __init__(self, name: str, gate: Gate, stop: Callable[[str], None]):
        self.name, self.gate, self.stop = name, gate, stop
        self.seen: list[tuple[int, int, int, bool]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None or not row["rows"]:
            return
        ok = self.gate.admits(row["rows"], row["good"])
        self.seen.append((event.progress.batchId, row["rows"], row["good"], ok))
        if not ok:
            self.stop(str(event.progress.id))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
