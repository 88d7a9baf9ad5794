r"""Spelling variants: words that differ in one letter, and the frequent word that each rare one stands for.

``vocabulary`` counts the words of a corpus, ``variants`` finds for each word the near words (one code point
inserted, deleted or replaced), its form (the most frequent near word, if that is ``RATIO`` times as
frequent) and its root (from form to form).

Near words are found by search schemes in bidirectional FM-indexes (``fm_index``): one half of a word is
matched exactly, then the search crosses the other half with one error.  No index holds the whole vocabulary.  A word goes to
the shard of its first three and to that of its last four code points; as words have seven or more, a near
word shares the first of them (then the error lies beyond) or the second, and each half is searched in the shard where its
partners are.  A group of words with the same end that outgrows ``SHARD`` code points is dealt anew by its whole
exact half, and again by half of what is left, as long as it is too large: a word's searches are then split by
the place of the error, so no search is lost and none is made twice.  Shards are bounded, pairs never leave them: a shard gives one row for
each word, its near words counted and the best of them named.

Words of the query: runs `[A-Za-zÀ-ÿ]+`, A-Z lowered; where 31 divides the crc32 h of ``<doc_id>:<run>``,
the code point at h % length is left out; at least ``LEAST_LENGTH`` code points, found ``LEAST_COUNT`` times or more.

Defined cases: null texts have no words; a null doc_id counts as empty text; repeated rows count each time; ties between near words go
to the smallest in code-point order; an empty table gives an empty result; a very long run is a word like others (a shard holds
at least one); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import Scratch, read_table, shuffle_files_removed
from aeris.llm.fm_index import WordIndex

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
HEAD, TAIL = 3, 4  # code points that halves of a word of LEAST_LENGTH or more hold at least
SHARD = 1 << 19  # code points in an index, about
FEW = 32  # rows of a group that are never dealt anew, however long the words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """One row (word) for each run that gives a word of ``least`` or more code points."""
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(rf"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc"),
                       F.explode(runs).alias("_run")).withColumn("_run", F.translate("_run", UPPER, LOWER))
    h = F.crc32(F.concat("_doc", F.lit(":"), "_run").cast("binary"))
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.expr("substring(_run, 1, cast(_h % length(_run) as int))"), F.col("_run").substr(at + 2, F.length("_run")))
    return rows.withColumn("_h", h).select(F.when(F.col("_h") % 31 == 0, cut).otherwise(F.col("_run")).alias("word")).filter(
        F.length("word") >= least)


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words found ``count`` times or more."""
    return words_of(docs, least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


def _ends(q: Column, low: Column, high: Column) -> Column:
    """Name of the group of a query of ``q`` code points whose error lies at low .. high - 1: what lies before and after."""
    tail = F.expr("substring(word, greatest(length(word) - greatest(q - high, 0) + 1, 1))")
    return F.xxhash64(q, low, high, F.col("word").substr(F.lit(1), low), F.when(q > high, tail).otherwise(F.lit("")))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row once for either half of its stretch low .. high."""
    mid = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    parts = F.array(F.struct(F.col("low").alias("low"), mid.alias("high")), F.struct(mid.alias("low"), F.col("high").alias("high")))
    return rows.withColumn("_p", F.explode(F.filter(parts, lambda p: p["low"] < p["high"]))).withColumn(
        "low", F.col("_p.low")).withColumn("high", F.col("_p.high")).drop("_p")


def _dealt(words: DataFrame, made: Scratch, shard: int) -> DataFrame:
    """(key, word, n, query, low, high): the groups that shards are filled with.

    ``query`` rows search in their group for words whose first difference lies at low .. high - 1; all rows of a group are
    indexed.
    """
    size, half = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    start = F.array(
        F.struct(F.xxhash64(F.lit(0), F.col("word").substr(1, HEAD)).alias("key"), half.alias("low"), (size + 1).alias("high")),
        F.struct(F.xxhash64(F.lit(1), F.expr(f"right(word, {TAIL})")).alias("key"), F.lit(0).alias("low"), half.alias("high")))
    rows = words.select("word", "n", F.explode(start).alias("_s")).select(
        "_s.key", "word", "n", size.alias("q"), F.lit(True).alias("query"), "_s.low", "_s.high")
    done, k = [], 0
    while True:
        counts = rows.groupBy("key").agg(F.sum(F.length("word") + 1).alias("size"), F.max(F.col("high") - F.col("low")).alias("open"),
                                         F.count(F.lit(1)).alias("rows"))
        large = made(counts.filter((F.col("size") > shard) & (F.col("open") > 1) & (F.col("rows") > FEW)).select("key"), f"large-groups-{k}")
        if large.isEmpty():
            break
        done.append(rows.join(large, "key", "left_anti"))
        hot = rows.join(large, "key")
        if k == 0:  # partners may be shorter or longer by one: be found by queries of each of the three lengths
            lengths = F.array(*[F.struct((size + d).alias("q"), F.lit(d == 0).alias("query")) for d in (-1, 0, 1)])
            hot = hot.withColumn("right", F.col("low") > 0).withColumn("_l", F.explode(lengths)).withColumn(
                "q", F.col("_l.q")).withColumn("query", F.col("_l.query")).drop("_l")
            half = F.floor(F.col("q") / 2).cast("int")
            hot = hot.withColumn("low", F.when(F.col("right"), half).otherwise(F.lit(0))).withColumn(
                "high", F.when(F.col("right"), F.col("q") + 1).otherwise(half)).drop("right")
        else:
            hot = _halves(hot)
        rows = made(hot.withColumn("key", _ends(F.col("q"), F.col("low"), F.col("high"))).select(
            "key", "word", "n", "q", "query", "low", "high"), f"dealt-again-{k}")
        k += 1
    for more in done:
        rows = rows.unionByName(more)
    return rows.select("key", "word", "n", "query", "low", "high")


_FOUND = "word string, n_near long, best_n long, best string"
_ARROW = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _search(table: pa.Table) -> pa.Table:
    """Near words of the queries of one shard: how many, and the most frequent."""
    rows = table.column("word").to_pylist()
    words = sorted(set(rows))
    if len(words) < 2:
        return _ARROW.empty_table()
    number = {w: k for k, w in enumerate(words)}
    place = np.array([number[w] for w in rows], np.int64)
    n = np.zeros(len(words), np.int64)
    n[place] = table.column("n").to_numpy()
    asks = table.column("query").to_numpy(zero_copy_only=False)
    queries = np.unique(np.stack([place[asks], *[table.column(c).to_numpy()[asks].astype(np.int64) for c in ("low", "high")]]), axis=1)
    if not queries.shape[1]:
        return _ARROW.empty_table()
    at, near = WordIndex(words).near(*queries)
    order = np.lexsort((np.arange(len(words)), -n))  # frequent first, then code points
    standing = np.empty(len(words), np.int64)
    standing[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    np.add.at(count, queries[0][at], 1)
    np.minimum.at(best, queries[0][at], standing[near])
    found = np.flatnonzero(count)
    top = order[best[found]]
    return pa.Table.from_arrays([pa.array([words[k] for k in found], pa.string()), pa.array(count[found]), pa.array(n[top]),
                                 pa.array([words[k] for k in top], pa.string())], schema=_ARROW)


def near_words(words: DataFrame, made: Scratch, shard: int = SHARD) -> DataFrame:
    """(word, n, n_near, best_n, best) of every row of ``words`` (word, n); best is null without a near word."""
    rows = made(_dealt(words, made, shard), "word-groups")
    total = rows.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    shards = max(1, -(-total // shard))
    found = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(
        _search, _FOUND)
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"))
    some = found.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best")
    ranked = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("r"), F.col("best").alias("w")))
    return none.unionByName(some).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(ranked).alias("b")).select(
        "word", "n", "n_near", (-F.col("b.r")).alias("best_n"), F.col("b.w").alias("best"))


def variants(words: DataFrame, ratio: int = RATIO, shard: int = SHARD, kept: list[str] | None = None) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of ``words`` (word, n; each word once)."""
    with Scratch(words.sparkSession, kept) as made, shuffle_files_removed(words.sparkSession):
        near = near_words(made(words.select("word", "n"), "vocabulary"), made, shard)
        frequent = F.col("best_n") >= ratio * F.col("n")
        table = made(near.select("word", "n", "n_near", F.when(frequent, F.col("best")).alias("form"),
                                 F.when(frequent, F.col("best_n")).alias("form_n")), "near-words")
        links = table.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
        k = 0
        while True:  # each round doubles the steps that a link spans; a form is ten times as frequent, so chains are short
            links = made(links, f"links-{k}")
            ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
            if links.join(ahead, "root", "left_semi").isEmpty():
                break
            links = links.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
            k += 1
        return made.keep(table.join(links, "word", "left").select(
            "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")), "variants")


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(vocabulary(docs)).select("word", "form", "root", "n", "n_near", "form_n")


def crc32_sql(source: str, key: str) -> str:
    """CTEs that end in ``crc`` (k, h): crc32 of the UTF-8 bytes of column ``key`` for each row of ``source`` (k, ``key``)."""
    return f"""
bits(b, c, j) AS (SELECT range::BIGINT, range::BIGINT, 0 FROM range(256) UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, j + 1 FROM bits WHERE j < 8),
t0 AS MATERIALIZED (SELECT b, c AS t FROM bits WHERE j = 8),
longest AS MATERIALIZED (SELECT coalesce(max(strlen({key})), 0) AS n FROM {source}),
ahead(b, t, k) AS (SELECT b, t, 0 FROM t0 UNION ALL
  SELECT a.b, xor(t0.t, a.t >> 8), k + 1 FROM ahead a JOIN t0 ON t0.b = a.t & 255 WHERE k < (SELECT n FROM longest)),
zeros(z, k) AS (SELECT 4294967295::BIGINT, 0 UNION ALL
  SELECT xor(t0.t, z >> 8), k + 1 FROM zeros JOIN t0 ON t0.b = z & 255 WHERE k < (SELECT n FROM longest)),
byte AS (SELECT k, strlen({key}) AS n, i, (instr('0123456789ABCDEF', substr(x, 2 * i + 1, 1)) - 1) * 16
           + instr('0123456789ABCDEF', substr(x, 2 * i + 2, 1)) - 1 AS b
         FROM (SELECT k, {key}, hex(encode({key})) AS x, unnest(range(strlen({key}))) AS i FROM {source})),
crc AS MATERIALIZED (SELECT byte.k, xor(xor(bit_xor(ahead.t), any_value(z)), 4294967295) AS h
        FROM byte JOIN ahead ON ahead.b = byte.b AND ahead.k = byte.n - 1 - byte.i JOIN zeros ON zeros.k = byte.n GROUP BY byte.k)"""


ORACLE_SQL = rf"""
WITH RECURSIVE run AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
seen AS MATERIALIZED (SELECT row_number() OVER () AS k, coalesce(doc_id::VARCHAR, '') || ':' || w AS s, w, n
                      FROM (SELECT doc_id, w, count(*) AS n FROM run WHERE length(w) >= 7 GROUP BY ALL)),
{crc32_sql("seen", "s")},
word AS MATERIALIZED (SELECT w, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n
    FROM seen JOIN crc ON seen.k = crc.k) WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
less AS MATERIALIZED (SELECT w, n, i, substr(w, 1, i) || substr(w, i + 2) AS v FROM (SELECT w, n, unnest(range(length(w))) AS i FROM word)),
pair AS (SELECT a.w, b.w AS o, b.n FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.w <> b.w
         UNION SELECT a.w, b.w, b.n FROM less a JOIN word b ON a.v = b.w
         UNION SELECT b.w, a.w, a.n FROM less a JOIN word b ON a.v = b.w),
best AS (SELECT w, count(*)::BIGINT AS n_near, min(struct_pack(r := -n, o := o)) AS b FROM pair GROUP BY w),
form AS MATERIALIZED (SELECT word.w, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.r >= 10 * word.n THEN b.o END AS form,
                CASE WHEN -b.r >= 10 * word.n THEN -b.r END AS form_n FROM word LEFT JOIN best ON best.w = word.w),
walk(w, place, form) AS (SELECT w, w, form FROM form UNION ALL
                      SELECT walk.w, form.w, form.form FROM walk JOIN form ON form.w = walk.form)
SELECT form.w AS word, form.form, walk.place AS root, n, n_near, form_n::BIGINT AS form_n
FROM form JOIN walk ON walk.w = form.w AND walk.form IS NULL
"""
