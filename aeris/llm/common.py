"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris import session
from aeris.session import remove_paths

FOLDS = 5
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and reread it; an open ``Scratch`` deletes it when it ends."""
    return session.materialize(df, name, _written.get())


class Scratch:
    """Tables that an operator writes on its way; all but the kept ones are deleted when the block ends.

    ``with Scratch(spark) as made:`` ... ``materialize(df, name)`` or ``made(df, name)`` writes and rereads a table,
    ``made.keep(df, name)`` does so for one that the result reads.  Paths of kept tables go to ``kept``, for the caller to delete
    when the result is written.
    """

    def __init__(self, spark: SparkSession, kept: list[str] | None = None):
        self.spark, self.paths, self.kept = spark, [], kept if kept is not None else []

    def __enter__(self):
        self.token = _written.set(self.paths)
        return self

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return session.materialize(df, name, self.paths)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return session.materialize(df, name, self.kept)

    def __exit__(self, *_):
        _written.reset(self.token)
        remove_paths(self.spark, self.paths)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id,
                              F.lit("")).cast("binary")) % FOLDS


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def whole_rows(df: DataFrame) -> DataFrame:
    """Each row as one struct ``_row``, so that columns added beside it cannot clash with its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times in ``body`` (evaluated a single time per row)."""
    return F.transform(F.array(value), body).getItem(0)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return fold(doc_id) == 0


def append_columns(df: DataFrame, fields: list[tuple[str, T.DataType]], fn) -> DataFrame:
    """``df`` with new columns that ``fn(batch)`` gives as Arrow arrays, batch by batch.

    A column of ``df`` that bears one of the new names is replaced.  Rows
    stay where they are read, in the same number and order.
    """
    names = {n.lower() for n, _ in fields}
    kept = df.select(*[c for c in df.columns if c.lower() not in names])
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in fields]])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *fn(b)], names=[*b.schema.names, *[n for n, _ in fields]])

    return kept.mapInArrow(run, schema)


def bounded_sample(df: DataFrame, by: str, per_value: int, key: str = "doc_id", salt: int = 7, values: int = 100):
    """(about ``per_value`` rows for each of the ``values`` most frequent values of ``by``, rows there are of each).

    The counts per value come from one partial aggregate, of which ``values`` rows reach the driver; they are joined to the
    rows as a small table.  Rows are chosen by a hash of all their columns, so nothing
    else is shuffled and rows that share ``key`` are drawn one by one; equal rows come together.  Where there are fewer
    rows than the bound, all are taken.
    """
    top = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col(by)).limit(values).collect()
    counts = {r[by]: r["n"] for r in top}
    shares = df.sparkSession.createDataFrame([(v, min(1.0, per_value / max(n, 1))) for v, n in counts.items()],
                                             T.StructType([T.StructField("_value", df.schema[by].dataType), T.StructField("_share", T.DoubleType())]))
    spot = F.pmod(F.xxhash64(F.lit(salt), *[F.col(c) for c in dict.fromkeys([key, *df.columns])]), F.lit(1 << 30)) / float(1 << 30)
    drawn = df.join(F.broadcast(shares), F.col(by).eqNullSafe(F.col("_value"))).filter(spot < F.col("_share"))
    return drawn.select(*df.columns), counts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_value: int):
    """(doc_id, text, lang, label, fold) of a bounded sample of labelled training rows, and label counts.

    The sample is drawn from the labels, so what is broadcast is bounded by
    ``per_value`` rows for each of the two labels.
    """
    train = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    drawn, counts = bounded_sample(train, "label", per_value)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select("doc_id", whole_text().alias("text"), lang.alias("lang"))
    return texts.join(F.broadcast(drawn), "doc_id").withColumn("fold", fold().cast("int")), counts


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """While this is open, Spark removes the shuffle files of every SQL execution when it has ended.

    For operators that write each phase to the shared folder and never run a plan twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id for every vertex of ``edges`` (a, b): rows (id, component).

    Alternates large-star and small-star contraction; each round is two
    groupings that keep only minima, and its edges are written to the
    shared folder, so a lost executor costs one round.  The number of rounds is
    logarithmic in the longest chain.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    spark = edges.sparkSession
    current = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                                        F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    for k in range(1, max_rounds + 1):
        if not state["n"]:
            break
        near = both(current)
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: every larger neighbour of a vertex is linked to the vertex's smallest neighbour
        large = near.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: a vertex and its smaller neighbours are linked to the smallest of them
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                                                F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b").distinct())
        current = materialize(small, f"{name}-{k}")
        last, state = state, current.agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if last == state:
            break
    else:
        raise RuntimeError(f"components of {name} did not settle in {max_rounds} rounds")
    roots = current.groupBy("a").agg(F.min("b").alias("component"))
    members = both(edges).select(F.col("a").alias("id")).distinct()
    return members.join(roots.withColumnRenamed("a", "id"), "id", "left").select(
        "id", F.coalesce("component", "id").alias("component"))
