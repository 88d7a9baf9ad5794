"""JSON event publishing and ingest.

Upstream replays a table through a message broker one row at a time and
buffers records in the driver before writing parquet.  Here:

* publishing is one distributed write of ``to_json(struct(*))`` lines (or a
  Kafka write when the connector is on the classpath);
* ingest is one Structured Streaming query: text (or Kafka) source ->
  ``from_json`` with a fixed schema -> parquet;
  a batch writes its own folder and a replayed batch writes the same one again, which
  makes the output exactly-once; ``availableNow`` drains what is there
  and stops (S9), ``maxFilesPerTrigger``, ``maxBytesPerTrigger`` and ``maxOffsetsPerTrigger`` bound a
  micro-batch (S10);
* payloads that are not one JSON object go to a rejects folder, always (S8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

# JSON options: keep null fields (as upstream does) and microsecond timestamps.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
CORRUPT = "_corrupt_record"


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``value``; null fields kept."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias("value"))


def publish_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a table as JSON lines, the file form of an event topic (S5); a file for each task of the table."""
    to_json_lines(df).write.mode(mode).text(path)


def publish_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Write a table to a Kafka topic (needs the spark-sql-kafka connector)."""
    (to_json_lines(df).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def decode(raw: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Parse JSON payloads; adds ``_is_object``.

    A payload is accepted when it is one JSON object that parses, with white space
    around it at most; arrays, bare ``null``, empty and malformed text and anything that
    follows the object are flagged, because ``from_json`` alone lets several of them pass.
    """
    text = F.col(value).cast("string")
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    opts = dict(JSON_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    parsed = raw.select(text.alias("__raw"), F.from_json(text, full, opts).alias("__r"))
    # what follows an object and still parses must end the array in one form and the outer object in the other: nothing can do both
    alone = (F.json_array_length(F.concat(F.lit("["), F.col("__raw"), F.lit("]"))) == 1) & (
        F.size(F.json_object_keys(F.concat(F.lit('{"x":'), F.col("__raw"), F.lit("}")))) == 1)
    is_object = (F.col("__raw").rlike(r"^\s*\{") & alone & F.col("__r").isNotNull() & F.col(f"__r.{CORRUPT}").isNull())
    return parsed.select("__raw", *[F.col(f"__r.{f.name}").alias(f.name) for f in schema.fields],
                         F.coalesce(is_object, F.lit(False)).alias("_is_object"))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("_is_object")).drop("_is_object", "__raw")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~F.col("_is_object")).select(F.col("__raw").alias("payload"))


def read_events(spark: SparkSession, source: str, fmt: str = "text",
                max_per_trigger: int | None = None, topic: str | None = None,
                servers: str | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming source of raw payloads: JSON-lines files, or a Kafka topic.

    A batch takes files until ``max_per_trigger`` of them or ``max_bytes_per_trigger`` bytes are reached (S10), one file at least.
    """
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("subscribe", topic).option("startingOffsets", "earliest"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(source)


def ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: StructType,
           fmt: str = "text", max_per_trigger: int | None = None,
           block_size: int = 64 * 1024 * 1024, rejects: str | None = None,
           available_now: bool = True, processing_time: str | None = None, files_per_batch: int | None = None,
           **source_opts) -> StreamingQuery:
    """Start the ingest query (S6, T5); accepted rows go below ``sink``, others below ``rejects``.

    ``rejects`` is ``<sink>_rejects`` unless named.  Every batch writes ``batch_id=N`` in both, each straight from the
    source, so nothing of a backlog is held on executors; read them back with ``ingested``.  ``files_per_batch`` bounds the
    files a batch writes (1 as upstream); without it there is one for each task of the source.
    """
    away = rejects or f"{sink.rstrip('/')}_rejects"
    decoded = decode(read_events(spark, source, fmt, max_per_trigger, **source_opts), schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = accepted(batch).coalesce(files_per_batch) if files_per_batch else accepted(batch)
        rows.write.mode("overwrite").option("parquet.block.size", str(block_size)).parquet(f"{sink}/batch_id={batch_id}")
        rejected(batch).write.mode("overwrite").json(f"{away}/batch_id={batch_id}")

    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 second")
    return writer.start()


def finished_batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of the batches that were written to their end (those with a success marker)."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch_id=*/_SUCCESS")
    fs = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getParent().toString() for s in fs.globStatus(found) or [])


def ingested(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """The accepted rows of all finished batches."""
    done = finished_batches(spark, sink)
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)


def refused(spark: SparkSession, rejects: str) -> DataFrame:
    """The rejected payloads of all finished batches."""
    done = finished_batches(spark, rejects)
    return spark.read.schema("payload string").json(done) if done else spark.createDataFrame([], "payload string")


def unique_events(events: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Events in flight, each key once: a repeat within ``delay`` of the first is dropped.

    ``time`` is the event time.  A key is forgotten when the watermark (the latest time seen, less ``delay``) has passed its
    event by ``delay``, at the end of a batch, so the state holds the keys of that stretch only; events behind the watermark
    of the batch before are dropped.
    """
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def ingest_unique(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: StructType, keys: list[str], time: str, delay: str,
                  max_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Ingest with duplicates removed across batches; the file sink commits every batch once."""
    rows = unique_events(accepted(decode(read_events(spark, source, max_per_trigger=max_per_trigger), schema)), keys, time, delay)
    writer = rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")).start()


def await_query(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def json_round_trip(df: DataFrame) -> DataFrame:
    """Encode every row as a JSON object and decode it again (batch form of S5 + S6)."""
    decoded = decode(to_json_lines(df), StructType(df.schema.fields))
    return accepted(decoded)
