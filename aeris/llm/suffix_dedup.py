"""Repeated byte strings across documents, by a distributed difference-cover algorithm.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the same
document or another.  Only the order of suffixes up to LENGTH bytes matters for that, so
the difference-cover construction is cut off there and works in four steps:

1. Sample.  In every document the positions whose remainder modulo ``PERIOD`` lies in a
   perfect difference set (a ninth part of them) are sampled.  For any two places there is a shift below PERIOD that
   brings both to sampled positions, so two equal strings of LENGTH bytes share
   the ``NAME_LENGTH`` bytes that follow such a pair.  These bytes are a sample's name.
2. Sort the samples by name, over all documents.  A suffix with a unique name is told apart from
   all others and is discarded; as names are as long as equal strings surely share, the
   recursion that would refine the rest ends after its first level.
3. Merge in the remaining suffixes: those that start less than PERIOD before a
   sample that is left.  They are sorted by their LENGTH-byte prefix.
4. Compare neighbours: an equal neighbour makes a suffix's prefix a repeated string.

Sorting is done in buckets by the leading bits of the names; tasks send packed arrays, one row for each bucket,
not one row for each suffix.  A name that occurs often in a task is sent once and its places are marked
right there, so no bucket grows with a passage that all documents share.  Names and prefixes are
compared by hash (40 bits and more for names, which only choose candidates; 64 bits for prefixes).

Texts with the same bytes are one text: where it has copies and LENGTH bytes or more it goes whole, and one
of them stands for all.  Defined cases: a null text counts as empty; texts shorter than LENGTH bytes stay whole;
rows that repeat a doc_id are documents of their own; an empty table gives an empty result; other
columns are ignored.  Long texts are hashed block by block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import Scratch, materialize, read_table, shuffle_files_removed, whole_rows, whole_text
from aeris.llm.hashing import prefix_sums, range_hashes

LENGTH = 200
# The powers of 2 modulo 73 are a perfect difference set: every shift is a difference of two of them.
PERIOD = 73
COVER = np.array(sorted(pow(2, k, PERIOD) for k in range(9)))
NAME_LENGTH = LENGTH - PERIOD + 1
BLOCK = 1 << 21  # bytes hashed at a time
TOGETHER = 1 << 20  # suffixes a task packs at a time
PER_BUCKET = 4_000_000  # bytes of text for each bucket, about
NAME_BYTES, PREFIX_BYTES = 5, 7  # sent for each suffix, besides the bits that the bucket gives
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_PACKED = "batch long, kind int, bucket int, n int, data binary"
TEXTS, MARKED, SENT = 0, 1, 2  # kinds of packed rows: what a batch holds; repeated suffixes; suffixes for a bucket


def sampled(n: int) -> np.ndarray:
    """Sampled positions of a text of ``n`` bytes that have a whole name after them."""
    last = n - NAME_LENGTH
    if n < LENGTH:
        return np.zeros(0, np.int64)
    at = (np.arange(0, last + 1, PERIOD)[:, None] + COVER).reshape(-1)
    return at[at <= last]


def hashes_at(raw: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` bytes after each of the sorted positions."""
    out = []
    k = 0
    while k < len(at):
        first = int(at[k])
        stop = int(np.searchsorted(at, first + BLOCK))
        own = at[k:stop] - first
        sums = prefix_sums(raw[first:int(at[stop - 1]) + length])
        out.append(range_hashes(sums, own, own + length))
        k = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _planes(a: np.ndarray, size: int, used: int) -> bytes:
    """Low ``used`` bytes of the numbers, byte by byte of all of them (which compresses well)."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, size)[:, :used].T).tobytes()


def _numbers(raw: bytes, n: int, used: int, size: int) -> np.ndarray:
    out = np.zeros((n, size), np.uint8)
    out[:, :used] = np.frombuffer(raw, np.uint8, n * used).reshape(used, n).T
    return out.reshape(-1).view(np.uint32 if size == 4 else np.uint64)


class Packer:
    """Collects the hashed suffixes of texts and gives the packed rows of a batch."""

    def __init__(self, bits: int, used: int):
        self.bits, self.used, self.ordinal = bits, used, 0
        self.clear()

    def clear(self) -> None:
        self.parts: list[np.ndarray] = []
        self.texts: list[bytes] = []
        self.n = 0

    def add(self, about: bytes, hashes: np.ndarray) -> None:
        self.parts.append(hashes)
        self.texts.append(about)
        self.n += len(hashes)

    def rows(self):
        if not self.n:
            return None
        names = np.concatenate(self.parts)
        # named after its texts, so a task that is run again gives the same batches
        batch = int.from_bytes(hashlib.sha256(b"".join(self.texts) + bytes([self.ordinal % 251])).digest()[:8], "little") >> 1
        order = np.argsort(names, kind="stable")
        sorted_ = names[order]
        same = sorted_[1:] == sorted_[:-1]
        first, again = np.r_[True, ~same], np.r_[same, False] | np.r_[False, same]
        out = [(batch, TEXTS, batch % (1 << self.bits), len(self.texts), zstandard.compress(b"".join(
            len(t).to_bytes(4, "little") + t + len(p).to_bytes(4, "little") for t, p in zip(self.texts, self.parts, strict=True)), 1))]
        if again.any():
            out.append(self.marked(batch, order[again], batch % (1 << self.bits)))
        sent = np.sort(order[first]).astype(np.uint32)
        own = names[sent]
        bucket = (own >> np.uint64(64 - self.bits)).astype(np.uint32)
        by = np.argsort(bucket, kind="stable")
        sent, own, bucket = sent[by], own[by] << np.uint64(self.bits), bucket[by]
        keep = own >> np.uint64(64 - 8 * self.used)
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            out.append((batch, SENT, int(bucket[a]), int(b - a), _planes(keep[a:b], 8, self.used) + _planes(sent[a:b], 4, 4)))
        self.clear()
        self.ordinal += 1
        return _batch(out)

    @staticmethod
    def marked(batch: int, index: np.ndarray, bucket: int) -> tuple:
        index = np.sort(index).astype(np.uint32)
        return batch, MARKED, bucket, len(index), _planes(index, 4, 4)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=[f.split()[0] for f in _PACKED.split(", ")])


def _sort_and_mark(packed: DataFrame, used: int) -> DataFrame:
    """Sort the sent suffixes of each bucket; MARKED rows for those with an equal neighbour, other rows as they are."""
    ordered = packed.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches):
        bucket, held = None, []

        def close():
            if len(held) < 2:  # a batch sends a name once
                return []
            names = np.concatenate([_numbers(d, n, used, 8) for _, n, d in held])
            order = np.argsort(names, kind="stable")
            same = names[order][1:] == names[order][:-1]
            again = np.zeros(len(names), bool)
            again[order[np.r_[same, False] | np.r_[False, same]]] = True
            out, at = [], 0
            for batch, n, d in held:
                mine = again[at:at + n]
                if mine.any():
                    out.append(Packer.marked(batch, _numbers(d[n * used:], n, 4, 4)[mine], bucket))
                at += n
            return out

        for b in batches:
            out = []
            for batch, kind, own, n, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if kind != SENT:
                    out.append((batch, kind, own, n, data))
                    continue
                if own != bucket:
                    out += close()
                    bucket, held = own, []
                held.append((batch, n, data))
            if out:
                yield _batch(out)
        if out := close():
            yield _batch(out)

    return ordered.mapInArrow(run, _PACKED)


def _by_text(marked: DataFrame, fn, schema: str, names: list[str], kinds: list) -> DataFrame:
    """Bring the marks of each batch back to its texts: ``fn(about, marks of the text)`` gives a row or None."""
    ordered = marked.repartition("batch").sortWithinPartitions("batch", "kind")

    def run(batches):
        current, texts, flags = None, [], None

        def close():
            rows, at = [], 0
            for about, n in texts:
                if flags[at:at + n].any() and (row := fn(about, flags[at:at + n])) is not None:
                    rows.append(row)
                at += n
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              names=names) if rows else None

        for b in batches:
            for batch, kind, _, n, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if batch != current:
                    if current is not None and (out := close()) is not None:
                        yield out
                    current, texts, flags = batch, [], None
                if kind == TEXTS and flags is not None:
                    continue  # another batch of the very same texts: its marks hold for both
                if kind == TEXTS:
                    raw, at = zstandard.decompress(data), 0
                    for _ in range(n):
                        size = int.from_bytes(raw[at:at + 4], "little")
                        about, at = raw[at + 4:at + 4 + size], at + 4 + size
                        texts.append((about, int.from_bytes(raw[at:at + 4], "little")))
                        at += 4
                    flags = np.zeros(sum(x for _, x in texts), bool)
                else:
                    flags[_numbers(data, n, 4, 4)] = True
        if current is not None and (out := close()) is not None:
            yield out

    return ordered.mapInArrow(run, schema)


def _sample(docs: DataFrame, bits: int) -> DataFrame:
    """Step 1: packed names of the samples of all texts."""
    def run(batches):
        packer, seen = Packer(bits, NAME_BYTES), set()
        for b in batches:
            for t in b.column(0):
                raw = t.as_py().encode("utf-8", "replace")
                if len(raw) < LENGTH:
                    continue
                digest = hashlib.sha256(raw).digest()
                if digest in seen:  # the same text again, in this batch
                    continue
                seen.add(digest)
                packer.add(digest, hashes_at(np.frombuffer(raw, np.uint8), sampled(len(raw)), NAME_LENGTH))
                if packer.n >= TOGETHER:
                    yield packer.rows()
                    seen.clear()
        if (rows := packer.rows()) is not None:
            yield rows

    return docs.select(whole_text().alias("t")).mapInArrow(run, _PACKED)


def _candidates(n: int, marks: np.ndarray) -> np.ndarray:
    """Starts of the suffixes that reach a marked sample within PERIOD and have LENGTH bytes."""
    at = sampled(n)[np.unpackbits(marks)[:len(sampled(n))].astype(bool)]
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, np.maximum(at - PERIOD + 1, 0), 1)
    change[at + 1] -= 1  # positions are distinct
    reach = np.cumsum(change)[:max(0, n - LENGTH + 1)] > 0
    return np.flatnonzero(reach)


def _runs(starts: np.ndarray) -> np.ndarray:
    """Runs of consecutive numbers: n x 2 (first, number)."""
    edges = np.flatnonzero(np.r_[True, np.diff(starts) != 1])
    return np.stack([starts[edges], np.diff(np.r_[edges, len(starts)])], axis=1)


def _merge(texts: DataFrame, bits: int) -> DataFrame:
    """Step 3: packed prefixes of the remaining suffixes of the texts (digest, ztext, marks)."""
    def run(batches):
        packer = Packer(bits, PREFIX_BYTES)
        for b in batches:
            for digest, z, marks in zip(*b.columns, strict=True):
                raw = zstandard.decompress(z.as_py())
                starts = _candidates(len(raw), np.frombuffer(marks.as_py(), np.uint8))
                if not len(starts):
                    continue
                about = bytes.fromhex(digest.as_py()) + _runs(starts).astype(np.int64).tobytes()
                packer.add(about, hashes_at(np.frombuffer(raw, np.uint8), starts, LENGTH))
                if packer.n >= TOGETHER:
                    yield packer.rows()
        if (rows := packer.rows()) is not None:
            yield rows

    return texts.select("digest", "ztext", "marks").mapInArrow(run, _PACKED)


def _covered(about: bytes, marks: np.ndarray) -> tuple[str, bytes]:
    """Step 4 for one text: the bytes that its repeated strings cover, as spans (start, end)."""
    runs = np.frombuffer(about[32:], np.int64).reshape(-1, 2)
    starts = np.repeat(runs[:, 0] - np.r_[0, np.cumsum(runs[:, 1])[:-1]], runs[:, 1]) + np.arange(runs[:, 1].sum())
    starts = starts[marks]
    edges = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + LENGTH])
    ends = np.r_[starts[edges[1:] - 1], starts[-1]] + LENGTH
    return about[:32].hex(), np.stack([starts[edges], ends], axis=1).astype(np.int64).tobytes()


def _zipped(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, ztext) of the texts that are long enough to hold a repeated string."""
    def run(batches):
        for b in batches:
            raw = [t.as_py().encode("utf-8", "replace") for t in b.column("t")]
            squeeze = zstandard.ZstdCompressor(3).compress
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                                              pa.array([squeeze(r) for r in raw], pa.binary())], ["doc_id", "digest", "ztext"])

    return docs.select("doc_id", whole_text().alias("t")).filter(F.octet_length("t") >= LENGTH).mapInArrow(
        run, "doc_id long, digest string, ztext binary")


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), whole_text().alias("text"))


def spans(docs: DataFrame, kept: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: doc_id, digest, n_bytes; copies: digest, copies, first; texts: digest, ztext, spans).

    ``texts`` holds those texts, one for all copies, that contain repeated strings.  These three tables are named in ``kept``; what
    else was written is deleted.
    """
    spark = docs.sparkSession
    with shuffle_files_removed(spark), Scratch(spark, kept) as made:
        own = _numbered(docs)
        rows = made.keep(own.select("doc_id", F.sha2("text", 256).alias("digest"),
                                      F.octet_length("text").cast("long").alias("n_bytes")), "texts")
        size = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
        bits = max(4, (size // PER_BUCKET).bit_length())
        names = materialize(_sort_and_mark(_sample(own, bits), NAME_BYTES), "sample-names")
        marks = materialize(_by_text(names, lambda about, flags: (about.hex(), np.packbits(flags).tobytes()),
                                     "digest string, marks binary", ["digest", "marks"], [pa.string(), pa.binary()])
                            .groupBy("digest").agg(F.first("marks").alias("marks")), "sample-marks")
        copies = made.keep(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first")), "copies")
        chosen = marks.join(copies, "digest").select("digest", "marks", F.col("first").alias("_first"))
        texts = materialize(_zipped(own).join(chosen, "digest").filter(F.col("doc_id") == F.col("_first"))
                            .select("digest", "ztext", "marks"), "candidate-texts")
        prefixes = materialize(_sort_and_mark(_merge(texts, bits), PREFIX_BYTES), "prefixes")
        found = materialize(_by_text(prefixes, _covered, "digest string, spans binary", ["digest", "spans"],
                                     [pa.string(), pa.binary()]).groupBy("digest").agg(F.first("spans").alias("spans")), "spans")
        held = made.keep(texts.select("digest", "ztext").join(found, "digest").dropDuplicates(["digest"]), "span-texts")
    return rows, copies, held


def _kept(raw: bytes, spans_: bytes) -> tuple[bytes, np.ndarray]:
    cut = np.frombuffer(spans_, np.int64).reshape(-1, 2)
    inner = np.r_[0, cut.reshape(-1), len(raw)].reshape(-1, 2)
    return b"".join([raw[a:b] for a, b in inner]), cut


def removed(docs: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    rows, copies, held = spans(docs, kept)

    def run(batches):
        for b in batches:
            out = []
            for digest, z, s in zip(*b.columns, strict=True):
                raw = zstandard.decompress(z.as_py())
                left, cut = _kept(raw, s.as_py())
                out.append((digest.as_py(), len(raw) - len(left), len(cut), hashlib.sha256(left).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out, strict=True)],
                                                 ["digest", "n_removed", "n_spans", "kept_sha256"])

    partial = held.select("digest", "ztext", "spans").mapInArrow(
        run, "digest string, n_removed long, n_spans long, kept_sha256 string")
    per_text = copies.select("digest", "copies").join(partial, "digest", "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    return rows.join(per_text, "digest").select(
        F.nullif("doc_id", F.lit((1 << 63) - 1)).alias("doc_id"), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"))


def _clean(raw: bytes, spans_: bytes) -> str:
    """What is left as text: a character goes only if all its bytes do."""
    cut = np.frombuffer(spans_, np.int64).reshape(-1, 2).copy()
    tail = np.r_[(np.frombuffer(raw, np.uint8) & 0xC0) == 0x80, False]  # continues a character
    for k in range(len(cut)):
        while tail[cut[k, 0]]:
            cut[k, 0] += 1
        while tail[cut[k, 1]]:
            cut[k, 1] -= 1
    return _kept(raw, cut[cut[:, 1] > cut[:, 0]].tobytes())[0].decode("utf-8")


def strip_repeats(docs: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """``docs`` with repeated strings taken out of text; n_chars follows where there is one."""
    _, copies, held = spans(docs, kept)

    def run(batches):
        for b in batches:
            texts = [_clean(zstandard.decompress(z.as_py()), s.as_py()) for z, s in zip(*b.columns[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["_digest", "_text"])

    partial = held.select(F.col("digest").alias("_digest"), "ztext", "spans").mapInArrow(run, "_digest string, _text string")
    many = copies.filter("copies > 1").select(F.col("digest").alias("_digest"), F.lit(True).alias("_many"))
    change = partial.join(many, "_digest", "full")
    text = F.col("_row.text").cast("string")
    out = whole_rows(docs).withColumn("_digest", F.sha2(F.coalesce(text, F.lit("")), 256)).join(change, "_digest", "left")
    gone = F.coalesce("_many", F.lit(False)) & (F.octet_length(text) >= LENGTH)
    left = F.when(gone, F.lit("")).otherwise(F.coalesce("_text", text))
    changed = gone | F.col("_text").isNotNull()
    cols = {c: F.col(f"_row.`{c}`") for c in docs.columns}
    cols["text"] = left
    if "n_chars" in cols:
        cols["n_chars"] = F.when(changed, F.length(left).cast(docs.schema["n_chars"].dataType)).otherwise(cols["n_chars"])
    return out.select(*[v.alias(c) for c, v in cols.items()])


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return removed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
