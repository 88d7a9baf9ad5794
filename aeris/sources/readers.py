"""Batch readers.

Counts and schema prints of the original are left to the caller (``df.count()`` when it is really
wanted).  A reader runs a job only to look at a folder's file names, where the path has no
suffix, or at the header of a CSV file that is read by column name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from aeris.functions.dates import parse_multi_format_date


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header row.

    With ``schema`` the read is typed and needs no inference pass (S1 with
    types); without one every column is a string (S1), or inferred when
    ``infer`` is set (S2, which costs an extra pass over the file).
    """
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_csv_named(spark: SparkSession, path: str, known: StructType) -> DataFrame:
    """CSV whose columns have the types of ``known`` by name, in any order; other columns are text.

    Nothing is inferred, so station ids that are all digits stay text (S2).  Dates may have any spelling that cleaning accepts.
    """
    types = {f.name: f.dataType for f in known.fields}
    header = spark.read.option("header", "true").csv(path).columns
    dates = [c for c in header if isinstance(types.get(c), DateType)]
    rows = read_csv(spark, path, StructType([StructField(c, StringType() if c in dates else types.get(c, StringType())) for c in header]))
    return rows.withColumns({c: parse_multi_format_date(c) for c in dates}) if dates else rows


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (S3); filters and projections are pushed into the scan."""
    return spark.read.parquet(path)


# Suffix of a path -> how it is read; a folder's own files decide where there is none of these.
FORMATS = {".parquet": "parquet", "/": "parquet", ".csv": "csv"}


def _format_of(spark: SparkSession, path: str) -> str:
    known = [fmt for suffix, fmt in FORMATS.items() if path.lower().endswith(suffix)]
    if known:
        return known[0]
    files = spark.read.format("binaryFile").load(path).select("path")   # names only, no contents
    return "csv" if files.filter(F.lower("path").endswith(".parquet")).isEmpty() else "parquet"


def read_any(spark: SparkSession, path: str, schema: StructType | None = None, known: StructType | None = None) -> DataFrame:
    """Path-dispatched scan (S4): parquet, or CSV with a header.

    CSV is read with ``schema``, or by column name with the types of ``known``, or is inferred.
    """
    if _format_of(spark, path) == "parquet":
        return read_parquet(spark, path)
    if schema is None and known is not None:
        return read_csv_named(spark, path, known)
    return read_csv(spark, path, schema=schema, infer=schema is None)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, each counted once; no job."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def read_many(spark: SparkSession, items: Iterable[tuple[str, str | None]],
              schemas: dict[str, StructType] | None = None) -> dict[str, DataFrame]:
    """Read (name, path) pairs, skipping entries without a path."""
    out: dict[str, DataFrame] = {}
    for name, path in items:
        if not path:
            continue
        out[name] = read_any(spark, path, (schemas or {}).get(name))
    return out
