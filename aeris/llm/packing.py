"""Best-fit packing of token pieces into sequences by exact-complement hashing.

Documents become ids plus a closing id; only longer ones are cut, into pieces
of ``CAPACITY``.  What decides a packing is how many pieces there are of each
length, at most CAPACITY numbers whatever the corpus holds.  From these counts the
driver draws up a plan:

1. for each length, from long to short, the gap it leaves is looked up among
   the single lengths, then the sums of two, then of three; a combination that
   fills the gap exactly is used as often as the counts allow, which uses up
   one of its lengths;
2. what no exact combination takes is placed by best fit, longest first, in
   the smallest gap that holds it.

The plan is a list of patterns with multiplicities (its size depends on CAPACITY alone).
Pieces get a rank among those of their length (ranked in salted groups,
so a length that a third of all pieces share is spread out), and length and
rank give sequence and offset by a search in the plan.

Defined cases: null text counts as empty (one piece, the closing id); rows
with equal doc_id are packed one by one; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aeris.llm import bpe
from aeris.llm.common import Scratch, read_table

CAPACITY = 4096
CLOSING_ID = 1
ROWS_PER_GROUP = 500  # pieces of one length ranked together, on average


class LibraryCoder(bpe.Bpe):
    """Ids by the tokenizers library: its model merges each new piece, the run table answers for known ones."""

    most_runs = 500_000  # ids only, so the table may be longer; emptied when the task ends

    def __init__(self, spec: str):
        super().__init__(spec)
        self.model = Tokenizer.from_str(spec).model
        self.symbols = dict(enumerate(bpe.byte_symbols()))

    def merge(self, piece: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.symbols))]

    def _run(self, run: str) -> bytes:
        ids = self._ids(run)
        return self._keep(run, struct.pack(f"<{len(ids)}I", *ids))

    def encode(self, text: str) -> np.ndarray:
        known, miss = self.runs.get, self._run
        return np.frombuffer(b"".join([known(r) or miss(r) for r in bpe.runs_of(text)]), "<u4")


@lru_cache(maxsize=2)
def library_coder(spec: str) -> LibraryCoder:
    return LibraryCoder(spec)


def cut(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    def fn(coder, kept, text):
        ids = np.append(coder.encode(text), np.array([CLOSING_ID], "<u4")).astype("<u4")
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            yield (*kept, k, a, len(part), zlib.crc32(part.tobytes()))

    return bpe.map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), bpe.read_vocabulary(path),
                         fn, "doc_id long, piece int, start long, length long, ids_crc32 long", ["doc_id"],
                         coder=library_coder)


def _pair_sums(avail: np.ndarray) -> np.ndarray:
    """How many ordered pairs of available lengths have each sum (index), up to the capacity."""
    size = 2 * len(avail)
    spread = np.fft.rfft((avail > 0).astype(np.float64), size)
    return np.rint(np.fft.irfft(spread * spread, size))[:len(avail)].astype(np.int64)


def _pairs(total: int, lengths: np.ndarray, avail: np.ndarray):
    low = lengths[lengths <= total // 2]
    for b in low[avail[total - low] > 0][::-1].tolist():
        yield (total - b, b)


def _fillers(gap: int, avail: np.ndarray):
    """Combinations of one, two or three available lengths whose sum is ``gap``, by hashed complement."""
    if avail[gap] > 0:
        yield (gap,)
    lengths = np.flatnonzero(avail[:gap])
    sums = _pair_sums(avail)
    if sums[gap]:
        yield from _pairs(gap, lengths, avail)
    for b in lengths[sums[gap - lengths] > 0][::-1].tolist():
        for pair in _pairs(gap - b, lengths, avail):
            yield (b, *pair)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns [(length, copies), ...] with the number of sequences of each."""
    avail = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        avail[length] = n
    made: list[tuple[list[tuple[int, int]], int]] = []
    if avail[capacity]:
        made.append(([(capacity, 1)], int(avail[capacity])))
        avail[capacity] = 0
    for anchor in range(capacity - 1, 0, -1):
        while avail[anchor] > 0:
            for combo in _fillers(capacity - anchor, avail):
                need = Counter((anchor, *combo))
                times = min(int(avail[x]) // k for x, k in need.items())
                if times:
                    break
            else:
                break
            for x, k in need.items():
                avail[x] -= k * times
            made.append((sorted(need.items(), reverse=True), times))
    return made + _best_fit(avail, capacity)


def _best_fit(avail: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Longest first into the smallest gap that holds it; sequences with equal contents are handled together."""
    bins: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}  # gap -> sequences that leave it
    gaps: list[int] = []  # its keys, sorted

    def put(gap: int, pattern: list[tuple[int, int]], n: int) -> None:
        if gap not in bins:
            insort(gaps, gap)
        bins.setdefault(gap, []).append((pattern, n))

    for length in np.flatnonzero(avail)[::-1].tolist():
        left = int(avail[length])
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                gap, pattern, n = capacity, [], left
            else:
                gap = gaps[at]
                pattern, n = bins[gap].pop()
                if not bins[gap]:
                    del bins[gap], gaps[at]
            each = gap // length
            full = min(n, left // each)
            left, n = left - full * each, n - full
            if full:
                put(gap - each * length, pattern + [(length, each)], full)
            if n and 0 < left < each:
                put(gap - left * length, pattern + [(length, left)], 1)
                left, n = 0, n - 1
            if n and pattern:
                put(gap, pattern, n)
    return [x for group in bins.values() for x in group]


def slots(patterns) -> dict[str, np.ndarray]:
    """The plan as arrays sorted by (length, first rank): where the pieces of a length and rank go."""
    used: Counter = Counter()
    rows, base = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, copies in pattern:
            rows.append((length, used[length], base, copies, offset))
            used[length] += copies * times
            offset += length * copies
        base += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "base", "copies", "offset"), a.T.copy(), strict=True))


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with length) plus sequence_id and offset; ``pieces`` is read twice, so give a written table."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = pieces.sparkSession.sparkContext.broadcast(slots(plan(counts, capacity)))
    spread = pieces.sparkSession.createDataFrame(
        [(k, 1 + n // ROWS_PER_GROUP) for k, n in counts.items()], "length long, _salts long")
    cols = pieces.columns
    salted = pieces.withColumn("_uid", F.monotonically_increasing_id()).join(F.broadcast(spread), "length").withColumn(
        "_salt", F.pmod(F.xxhash64("_uid"), F.col("_salts")))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.withColumn("_first", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_uid")) - 1
    ranked = salted.withColumn("_place", rank).join(first.drop("_n"), ["length", "_salt"]).select(
        *cols, (F.col("_first") + F.col("_place")).alias("_rank"))

    def assign(frames):
        t = table.value
        width = np.int64(1) << 40
        keys = t["length"] * width + t["rank"]
        for f in frames:
            length, rank = f["length"].to_numpy(np.int64), f["_rank"].to_numpy(np.int64)
            k = np.searchsorted(keys, length * width + rank, side="right") - 1
            past = rank - t["rank"][k]
            copies = t["copies"][k]
            yield f.drop(columns="_rank").assign(sequence_id=t["base"][k] + past // copies,
                                                 offset=t["offset"][k] + past % copies * length)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInPandas(assign, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, kept: list[str] | None = None) -> DataFrame:
    """Cut, encode and pack whole documents; the result reads the table of pieces that is named in ``kept``."""
    return place(Scratch(docs.sparkSession, kept).keep(cut(docs, path, capacity), "pieces"), capacity)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


