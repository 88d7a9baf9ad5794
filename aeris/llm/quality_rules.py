r"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` evaluates every rule once per document and stores the measurements
and one bit per failed rule.  Policies are versioned masks over those bits:
applying another one, or asking what a rule costs, reads the ledger and never
the texts.

Words are runs of characters other than blank and U+0009..U+000D; a line is
what stands between ``\n``.  Defined cases: a null text counts as empty (0
words, fails ``few_words``); an empty table gives an empty ledger; rows with
the same doc_id are judged one by one; extra columns are kept unless they
bear the name of a ledger column, which is then replaced.  A row is handled
where it is read: there is no shuffle, so no hot source or copied text can
gather in a task.  Repeated windows are found by 64-bit hash in one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import let, read_table, whole_rows, whole_text

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaims"]

# Rule name -> condition under which a document fails; the place in the list is the bit.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbol_heavy", "n_symbols > 2 * n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 25 * n_words"),
    ("exclaiming", "n_exclaims > n_words"),
]
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}

# Policy version -> the rules it enforces.  Old versions stay, so old verdicts can be repeated.
POLICIES: dict[str, list[str]] = {
    "base-1": ["few_words", "repeated_windows"],
    "prose-1": ["few_words", "repeated_windows", "symbol_heavy", "duplicate_lines"],
    "prose-2": [name for name, _ in RULES],
}
CURRENT = "prose-2"


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice."""
    n = F.size(words)

    def of_sorted(found: Column) -> Column:
        repeated = F.filter(found, lambda x, i: (F.coalesce(F.get(found, i - 1)["h"] == x["h"], F.lit(False))
                                                 | F.coalesce(F.get(found, i + 1)["h"] == x["h"], F.lit(False))))
        starts = F.sort_array(F.transform(repeated, lambda x: x["p"]))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - p, F.lit(3)))),
            F.lit(0), lambda acc, x: acc + x))

    def of_hashes(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(placed, of_sorted))

    hashes = F.transform(F.sequence(F.lit(0), n - 3),
                         lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 3, F.lit(0)).otherwise(let(hashes, of_hashes))


def measurements(text: Column) -> Column:
    """Struct of MEASURES (all long) for one non-null text."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))

    def of_words(words: Column) -> Column:
        return let(lines, lambda ls: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.size(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0))).cast("long").alias("n_symbols"),
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.regexp_extract_all(text, F.lit("!"), F.lit(0))).cast("long").alias("n_exclaims"),
        ))

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words)


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failed_bits`` (long, one bit per failed rule)."""
    replaced = {*MEASURES, "failed_bits"}
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in replaced]).alias("_row"),
                       measurements(whole_text(text_col)).alias("_m"))
    measured = rows.select("_row.*", *[F.col(f"_m.{m}").alias(m) for m in MEASURES])
    bits = F.lit(0).cast("long")
    for k, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed_bits", bits)


def verdict(policy: str = CURRENT) -> Column:
    """True where no rule of the policy failed."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(entries: DataFrame, policies: list[str] | None = None) -> DataFrame:
    """What each rule of each policy costs: (policy, rule, n_docs, n_rejected, n_failed, n_failed_alone).

    ``n_failed_alone`` documents would come back if the rule were dropped.  The
    ledger is first counted by bit pattern, at most 2**rules rows.
    """
    patterns = entries.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    cells = F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(rule).alias("rule"), F.lit(mask(p)).cast("long").alias("m"),
                 F.lit(BIT[rule]).cast("long").alias("b"))
        for p in (policies or list(POLICIES)) for rule in POLICIES[p]])
    hit = F.col("failed_bits").bitwiseAND(F.col("c.m"))

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))

    return (patterns.withColumn("c", F.explode(cells))
            .groupBy(F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule"))
            .agg(F.sum("n").alias("n_docs"), total(hit != 0).alias("n_rejected"),
                 total(F.col("failed_bits").bitwiseAND(F.col("c.b")) != 0).alias("n_failed"),
                 total(hit == F.col("c.b")).alias("n_failed_alone")))


def judge(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with base_failed and kept; both follow from the bits alone."""
    entries = ledger(docs)
    entries = entries.select(*[f"`{c}`" for c in entries.columns if c.lower() not in {"base_failed", "kept"}])
    return entries.withColumn("base_failed", ~verdict("base-1")).withColumn("kept", verdict("base-1") & verdict(policy))


def keep(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged."""
    rows = whole_rows(docs).withColumn("text", F.col("_row.text"))
    return judge(rows, policy).filter("kept").select("_row.*")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT k, unnest(gs) AS g, unnest(range(1, len(gs) + 1)) AS i
      FROM (SELECT k, list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS gs
            FROM w WHERE len(ws) >= 3)),
rep AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM g) WHERE c > 1),
cov AS (SELECT k, count(DISTINCT i + j) AS n FROM rep, range(0, 3) r(j) GROUP BY k),
m AS (SELECT w.k, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
             len(regexp_extract_all(t, '!'))::BIGINT AS n_exclaims
      FROM w LEFT JOIN cov ON w.k = cov.k),
b AS (SELECT *, (n_words < 50)::INT AS b0, (100 * n_repeat_words > 50 * n_words)::INT AS b1,
             (n_symbols > 2 * n_words)::INT AS b2, (n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines)::INT AS b3,
             (word_chars < 2 * n_words)::INT AS b4, (word_chars > 25 * n_words)::INT AS b5,
             (n_exclaims > n_words)::INT AS b6 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_exclaims,
       (b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5 + 64 * b6)::BIGINT AS failed_bits,
       (b0 + b1 > 0) AS base_failed, (b0 + b1 + b2 + b3 + b4 + b5 + b6 = 0) AS kept
FROM b
"""


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", *MEASURES, "failed_bits", "base_failed", "kept")
