"""Streaming country vulnerability (Q-E, T1-T4).

A file stream of scored weather runs the
same plan as the batch form in ``aeris.plans.vulnerability``: stream-static
left join to the city dimension, then an unwindowed per-country aggregation whose state is one row per
country.  No watermark is needed: state is bounded by the number of
countries.

Sinks: console (as upstream), memory, or a keyed table.  The keyed table is
written with ``foreachBatch``: batch N merges its update rows into the table of
the batch before and writes the whole (one row per country) to ``<path>/batch_id=N``
with overwrite, so a replayed batch writes the same folder again.  Older folders
are deleted but for the one before, which a replay needs.

The width of the state is the session's ``spark.sql.shuffle.partitions`` when the query
first starts; set it before, to about the number of cores, for a state this small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from aeris.session import remove_paths
from aeris.plans.vulnerability import (VULNERABILITY_COLUMNS, aggregate_risk, city_dimension,
                                       risk_events, vulnerability_metrics)

# State-store settings of the upstream streaming session (T4).
STREAM_CONF = {
    "spark.sql.streaming.stateStore.maintenanceInterval": "60s",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "1",
}


# State on local disk with changes uploaded batch by batch, for states larger than an executor's memory.
ROCKSDB_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stored_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Country and counts as the query's state store holds them in a checkpoint, at a batch or the last one.

    The buffers of ``aggregate_risk`` lie in its order and share names, so they are taken by place: those of the average
    first, then greatest and least score, the counts by level, and the number of events.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint)
    buffers = rows.schema["value"].dataType.fields
    named = rows.select(F.col("key")["country"].alias("country"),
                        F.col("value").cast(StructType([StructField(f"b{k}", f.dataType) for k, f in enumerate(buffers)])).alias("s"))
    last = ["max_risk_score", "min_risk_score", "low_cnt", "moderate_cnt", "high_cnt", "critical_cnt", "events"]
    return named.select("country", *[F.col(f"s.b{len(buffers) - len(last) + k}").alias(c) for k, c in enumerate(last)])


def configure_stream_session(spark: SparkSession, conf: dict[str, str] | None = None) -> None:
    """Apply the state-store settings (T4) to a session before starting the query."""
    for key, value in (conf or STREAM_CONF).items():
        spark.conf.set(key, value)


def vulnerability_plan(spark: SparkSession, weather_path: str, cities: DataFrame,
                       schema: StructType | None = None, max_files_per_trigger: int | None = None,
                       standardize_dimension: bool = True) -> DataFrame:
    """Streaming DataFrame of per-country vulnerability rows.

    Without ``max_files_per_trigger`` a micro-batch takes all new files (upstream: one).
    """
    schema = schema or spark.read.parquet(weather_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    dim = city_dimension(cities, standardize=standardize_dimension)
    return vulnerability_metrics(aggregate_risk(risk_events(reader.parquet(weather_path), dim)))


def start(plan: DataFrame, sink: str = "console", output_mode: str = "update",
          checkpoint: str | None = None, path: str | None = None, query_name: str = "climate_risk_score",
          trigger_seconds: int | None = 20, available_now: bool = False,
          num_rows: int = 20, truncate: bool = False) -> StreamingQuery:
    """Start the query on a console, memory or keyed-table sink."""
    writer = plan.writeStream.outputMode(output_mode).queryName(query_name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    if sink == "console":
        writer = writer.format("console").option("numRows", num_rows).option("truncate", str(truncate).lower())
    elif sink == "memory":
        writer = writer.format("memory")
    elif sink == "table":
        if not path:
            raise ValueError("sink='table' needs a path")

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            older = sorted(n for n in _batches(spark, path) if n < batch_id)
            merged = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            if older:
                last = spark.read.parquet(f"{path}/batch_id={older[-1]}")
                merged = merged.unionByName(last.withColumn("batch_id", F.lit(older[-1]).cast("long")))
            _newest(merged).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            remove_paths(spark, [f"{path}/batch_id={n}" for n in older[:-1]])

        writer = writer.foreachBatch(write_batch)
    else:
        raise ValueError(f"unknown sink {sink}")
    return writer.start()


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished batch folders below ``path``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root)]
    return [int(p.getName().split("=")[1]) for p in found
            if p.getName().startswith("batch_id=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def _newest(rows: DataFrame, key: str = "country") -> DataFrame:
    cols = [c for c in VULNERABILITY_COLUMNS if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("__row"))
    return newest.select(key, *[F.col(f"__row.{c}").alias(c) for c in cols])


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """The keyed table as of its newest batch."""
    return spark.read.parquet(f"{path}/batch_id={max(_batches(spark, path))}").select(*VULNERABILITY_COLUMNS)


def process_stream(spark: SparkSession, weather_path: str, cities: DataFrame,
                   checkpoint: str | None = None, trigger_seconds: int = 20,
                   timeout_seconds: float | None = None, output: str | None = None,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Run the vulnerability stream in update mode until stopped (E3): on the console, or into the keyed table ``output``.

    The session gets the state-store settings first.  ``timeout_seconds`` bounds
    the wait (``None`` waits until the query ends); an interrupt stops the
    query cleanly, and a failed query raises.
    """
    configure_stream_session(spark)
    query = start(vulnerability_plan(spark, weather_path, cities, max_files_per_trigger=max_files_per_trigger),
                  sink="table" if output else "console", path=output, output_mode="update", checkpoint=checkpoint,
                  trigger_seconds=trigger_seconds)
    try:
        query.awaitTermination(timeout_seconds) if timeout_seconds else query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        if query.isActive:
            query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
