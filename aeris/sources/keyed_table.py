"""Keyed tables of hash buckets, written copy-on-write under a manifest.

The rows of a table lie in ``buckets`` folders by the hash of some of their key columns.  A version is a manifest
that names the folder of each bucket.  ``upsert`` compares the loaded rows with those that are there by
key and digest, reads and writes only the buckets in which a row is new or different, and then commits the next
manifest by a rename, which fails where another writer was faster.  Files are never changed, so readers of an
older version go on; a load that breaks off leaves folders that no manifest names, which ``vacuum`` deletes.
A load that is repeated finds nothing to change, and one with a known ``batch_id`` is not even read.

Where all columns are keys (and none is a float or nested), a row that is there cannot differ: digests are left null, and
one aggregate by key over the loaded and the stored rows tells which are new.

Rows with a null in a key column are rows like others (null equals null).  Of loaded rows with the same
key the last by ``order_by`` wins, then the largest by all columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType, VariantType

from aeris.session import remove_paths

DIGEST, BUCKET = "_digest", "_bucket"
MANIFESTS = "_manifests"


@dataclass
class Manifest:
    version: int
    keys: list[str]
    bucket_by: list[str]
    buckets: int
    schema: str  # JSON of the rows' own columns
    folders: dict[str, str]  # bucket -> folder below the table
    batches: list[str] = field(default_factory=list)
    rewritten: int = 0

    def path(self, table: str) -> str:
        return f"{table}/{MANIFESTS}/{self.version:012d}.json"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, table: str) -> list[int]:
    fs, p = _file_system(spark, f"{table}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, table: str, version: int | None = None) -> Manifest | None:
    """The manifest of a version (the latest where none is named), None for a table that is not there."""
    known = _versions(spark, table)
    if not known or (version is not None and version not in known):
        return None
    text = spark.read.option("wholetext", "true").text(f"{table}/{MANIFESTS}/{(version or known[-1]):012d}.json").first()[0]
    return Manifest(**json.loads(text))


def _commit(spark: SparkSession, table: str, m: Manifest) -> None:
    fs, target = _file_system(spark, m.path(table))
    _, draft = _file_system(spark, f"{table}/{MANIFESTS}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(m.__dict__).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"version {m.version} of {table} was written by another load")


def _bucket(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in columns]), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, table: str, m: Manifest, buckets: Sequence[str] | None = None) -> DataFrame:
    """Rows of a version, digests included; of some buckets where they are named."""
    schema = StructType.fromJson(json.loads(m.schema)).add(DIGEST, "string")
    folders = [f"{table}/{m.folders[b]}" for b in (m.folders if buckets is None else buckets) if b in m.folders]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The rows of a version."""
    m = manifest(spark, table, version)
    if m is None:
        raise FileNotFoundError(f"no version {'of' if version is None else f'{version} of'} {table}")
    return _rows(spark, table, m).drop(DIGEST)


def _matches(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & a[f"`{c}`"].eqNullSafe(b[f"`{c}`"])
    return on


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Buckets below a folder, in order."""
    fs, p = _file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n.split("=")[1] for n in names if n.startswith(f"{BUCKET}="))


def _same_if_equal(kind: DataType) -> bool:
    """Equal values are the same value: not so with -0.0 and 0.0."""
    return not isinstance(kind, (FloatType, DoubleType, ArrayType, MapType, StructType, VariantType))


def _new_keys(own: DataFrame, there: DataFrame | None) -> DataFrame:
    """The distinct rows of ``own`` that are not ``there``, by all columns."""
    if there is None:
        return own.dropDuplicates()
    both = own.withColumn("_there", F.lit(False)).unionByName(there.withColumn("_there", F.lit(True)))
    return both.groupBy(*[F.col(f"`{c}`") for c in own.columns]).agg(F.bool_or("_there").alias("_there")).filter("NOT _there").drop("_there")


def _new_or_different(own: DataFrame, there: DataFrame | None, keys: Sequence[str], order_by: str | None, update: bool) -> DataFrame:
    """One row of ``own`` for each key, with its digest, without those that are ``there``: by key and digest, or by key."""
    last = [F.desc(order_by)] if order_by else []
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in own.columns]), {"ignoreNullFields": "false"}), 256)
    first = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*last, F.desc(DIGEST))
    fresh = own.withColumn(DIGEST, digest).withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")
    if there is None:
        return fresh
    there = there.select(*[F.col(f"`{c}`") for c in keys], DIGEST)
    return fresh.join(there, _matches(fresh, there, [*keys, DIGEST] if update else keys), "left_anti")


def upsert(df: DataFrame, table: str, keys: Sequence[str], buckets: int = 64, bucket_by: Sequence[str] | None = None,
           order_by: str | None = None, batch_id: str | None = None, update: bool = True) -> Manifest:
    """Bring the rows of ``df`` into the table and give the new manifest (the present one if nothing changes).

    ``keys`` and buckets are fixed by the first load.  With ``update=False`` a row whose key is there already is left as it is.
    """
    spark, table = df.sparkSession, table.rstrip("/")
    now = manifest(spark, table)
    if now is not None and batch_id is not None and batch_id in now.batches:
        return now
    keys, by = (now.keys, now.bucket_by) if now else (list(keys), list(bucket_by or keys))
    count = now.buckets if now else buckets
    columns = StructType.fromJson(json.loads(now.schema)).names if now else df.columns
    own = df.select(*[F.col(f"`{c}`") for c in columns])
    made = f"data/{(now.version if now else 0) + 1:012d}-{uuid.uuid4().hex[:12]}"
    if set(columns) <= set(keys) and all(_same_if_equal(f.dataType) for f in own.schema.fields):
        fresh = _new_keys(own, _rows(spark, table, now).drop(DIGEST) if now else None).withColumn(DIGEST, F.lit(None).cast("string"))
    else:
        fresh = _new_or_different(own, _rows(spark, table, now) if now else None, keys, order_by, update)
    fresh = fresh.withColumn(BUCKET, _bucket(by, count))
    if now is None:
        fresh.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{table}/{made}/rows")
        touched = _listed(spark, f"{table}/{made}/rows")
    else:
        # what changes is written once; its buckets, at most as many as the table has, are then known
        fresh.write.parquet(f"{table}/{made}/changes")
        changes = spark.read.parquet(f"{table}/{made}/changes")
        touched = sorted(str(r[0]) for r in changes.select(BUCKET).distinct().collect())
        if not touched:
            remove_paths(spark, [f"{table}/{made}"])
            if batch_id is None:
                return now
            m = Manifest(**{**now.__dict__, "version": now.version + 1, "batches": [*now.batches, batch_id], "rewritten": 0})
            _commit(spark, table, m)
            return m
        old = _rows(spark, table, now, touched)
        if update:  # else no key of the changes is there
            old = old.join(changes, _matches(old, changes, keys), "left_anti")
        rows = old.withColumn(BUCKET, _bucket(by, count)).unionByName(changes)
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{table}/{made}/rows")
        remove_paths(spark, [f"{table}/{made}/changes"])
    folders = {**(now.folders if now else {}), **{b: f"{made}/rows/{BUCKET}={b}" for b in touched}}
    m = Manifest(now.version + 1 if now else 1, keys, by, count, own.schema.json(), folders,
                 [*(now.batches if now else []), *([batch_id] if batch_id else [])], len(touched))
    _commit(spark, table, m)
    return m


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> int:
    """Delete the folders that none of the last ``keep`` versions names, and older manifests; gives how many folders went."""
    table = table.rstrip("/")
    known = _versions(spark, table)
    kept = [manifest(spark, table, v) for v in known[-keep:]]
    used = {f for m in kept for f in m.folders.values()}
    fs, data = _file_system(spark, f"{table}/data")
    gone = []
    for load in fs.listStatus(data) if fs.exists(data) else []:
        name = f"data/{load.getPath().getName()}"
        own = [f for f in used if f.startswith(f"{name}/")]
        if not own:
            gone.append(f"{table}/{name}")
            continue
        _, rows = _file_system(spark, f"{table}/{name}/rows")
        gone += [f"{table}/{name}/rows/{s.getPath().getName()}" for s in fs.listStatus(rows)
                 if s.isDirectory() and f"{name}/rows/{s.getPath().getName()}" not in used]
    count = len(gone)
    remove_paths(spark, [*gone, *[f"{table}/{MANIFESTS}/{v:012d}.json" for v in known[:-keep]]])
    return count
