"""Byte-pair encoding and decoding with a public vocabulary file.

A piece of text starts as one symbol per byte, held in a doubly linked list.
Candidate merges wait in a priority queue by merge rank, then place; an entry whose
symbols have since been merged into others is stale and is skipped when it
comes up.  Decoding concatenates vocabulary strings.

The vocabulary file is read once on the driver and broadcast (a few MB, a
fixed file), so executors need no copy of it.  Text is cut at white space;
no piece of the pre-tokeniser's pattern crosses white space, so each run between blanks can be
encoded on its own, and frequent runs are remembered in a table of bounded
size (when it is full, further runs are encoded but not kept; a task empties it at its end).

Defined cases: null text counts as empty (0 tokens, digests of the empty
string); names of special tokens in a text become their ids, as the public
library does; repeated rows are encoded one by one; an empty table gives an
empty result; other columns are ignored.  Rows never meet, so nothing is
shuffled and no hot key exists.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aeris.llm.common import read_table

KNOWN_RUNS = 150_000
KNOWN_PIECES = 50_000  # of runs that hold several
LONGEST_KNOWN = 64  # characters; longer runs are rare and are not kept

# The pre-tokeniser's pattern of the vocabulary file is read from it; white space is
# Unicode's White_Space property, which str.split() equals but for U+001C..U+001F.
_ODD_BLANK = re.compile("[\x1c-\x1f]")
_RUN = re.compile("[^\t-\r \x85\xa0  -     　]+")


def runs_of(text: str) -> list[str]:
    """Runs between white space; no pre-token reaches over it."""
    return _RUN.findall(text) if _ODD_BLANK.search(text) else text.split()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_vocabulary(path: str | None = None) -> str:
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return f.read()


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where printable, else the next free one from U+0100."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder for one vocabulary file (the text of its JSON)."""

    most_runs: int | None = None  # KNOWN_RUNS where not set

    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.strings = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for s, i in [*self.vocab.items(), *self.special.items()]:
            self.strings[i] = s
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        end = model["end_of_word_suffix"] or ""
        self.inner = [self.vocab[s] for s in byte_symbols()]
        self.final = [self.vocab[s + end] for s in byte_symbols()]
        split = next(p for p in d["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.byte_of = {s: b for b, s in enumerate(byte_symbols())}
        whole = Tokenizer.from_str(spec)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.forget()

    def forget(self) -> None:
        """Empty the tables of known runs and pieces; a task does so when it ends, as its worker may wait for others."""
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.runs: dict = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        n = len(piece)
        sym = [self.inner[b] for b in piece]
        sym[-1] = self.final[piece[-1]]
        merges, after, before = self.merges, list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for k in range(n - 1):
            if (found := merges.get((sym[k], sym[k + 1]))) is not None:
                queue.append((found[0], k, sym[k], sym[k + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, k, left, right, made = heapq.heappop(queue)
            nxt = after[k]
            if sym[k] != left or nxt >= n or sym[nxt] != right:
                continue  # stale
            sym[k], sym[nxt] = made, -1
            after[k] = nxt = after[nxt]
            if nxt < n:
                before[nxt] = k
                if (found := merges.get((made, sym[nxt]))) is not None:
                    heapq.heappush(queue, (found[0], k, made, sym[nxt], found[1]))
            if (prev := before[k]) >= 0 and (found := merges.get((sym[prev], made))) is not None:
                heapq.heappush(queue, (found[0], prev, sym[prev], made, found[1]))
        return [s for s in sym if s >= 0]

    def _piece(self, piece: str) -> tuple[int, ...]:
        if (ids := self.pieces.get(piece)) is None:
            ids = tuple(self.merge(piece.encode("utf-8")))
            if len(self.pieces) < KNOWN_PIECES and len(piece) <= LONGEST_KNOWN:
                self.pieces[piece] = ids
        return ids

    def _plain(self, run: str) -> list[int]:
        # characters are lowered one by one, so a capital sigma never becomes the final form
        low = unicodedata.normalize("NFC", run).replace("Σ", "σ").lower() if not run.isascii() else run.lower()
        if low.isalpha() and low.isascii():
            return self.merge(low.encode())
        if max(run) > "\u024f" and any(unicodedata.category(c) == "Cn" for c in run):
            # characters newer than Python's tables: case and class are those of the file's own normaliser and pre-tokeniser
            parts = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(run))
            return [i for part, _ in parts for i in self.merge(bytes([self.byte_of[c] for c in part]))]
        return [i for piece in self.pattern.findall(low) for i in self._piece(piece)]

    def _ids(self, run: str) -> list[int]:
        if self.special_split is None or "<|" not in run:
            return self._plain(run)
        ids = []
        for part in self.special_split.split(run):
            ids += [self.special[part]] if part in self.special else self._plain(part) if part else []
        return ids

    def _keep(self, run: str, out):
        if len(self.runs) < (self.most_runs or KNOWN_RUNS) and len(run) <= LONGEST_KNOWN:
            self.runs[run] = out
        return out

    def _run(self, run: str) -> tuple[int, str, str]:
        ids = self._ids(run)
        return self._keep(run, (len(ids), " ".join(map(str, ids)), self.decode(ids)))

    def _encoded(self, text: str) -> list[tuple]:
        known, miss = self.runs.get, self._run
        return [known(r) or miss(r) for r in runs_of(text)]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, little-endian unsigned 32 bits."""
        return np.array(" ".join([x[1] for x in self._encoded(text)]).split(), "<u4")

    def decode(self, ids) -> str:
        """Vocabulary strings of the ids, joined by a blank (the file names no decoder that would do otherwise)."""
        strings = self.strings
        return " ".join([strings[i] for i in ids])

    def digests(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids in decimal, sha256 of the decoded text)."""
        found = self._encoded(text)
        return (sum([x[0] for x in found]), hashlib.sha256(" ".join([x[1] for x in found]).encode()).hexdigest(),
                hashlib.sha256(" ".join([x[2] for x in found]).encode("utf-8")).hexdigest())


@lru_cache(maxsize=2)
def bpe_of(spec: str) -> Bpe:
    return Bpe(spec)


def map_texts(docs: DataFrame, spec: str, fn, schema: str, keep: list[str], text_col: str = "text",
              coder=bpe_of) -> DataFrame:
    """``fn(coder, kept values, text)`` yields result rows; one pass over whole texts, no shuffle."""
    spec_b = docs.sparkSession.sparkContext.broadcast(spec)
    source = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def run(batches):
        made = coder(spec_b.value)
        target = None
        for batch in batches:
            names = batch.schema.names
            kept = list(zip(*[batch.column(names.index(c)).to_pylist() for c in keep], strict=True))
            out = [row for k, t in zip(kept, batch.column(names.index("_text")), strict=True)
                   for row in fn(made, k, t.as_py())]
            target = target or _arrow_schema(schema)
            cols = list(zip(*out, strict=True)) if out else [()] * len(target)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, target, strict=True)],
                                             schema=target)
        made.forget()

    return source.mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(),
          "binary": pa.binary()}


def _arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([pa.field(n, _ARROW[t]) for n, t in (f.split() for f in schema.split(", "))])


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row."""
    def fn(bpe, kept, text):
        yield (*kept, *bpe.digests(text))

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), read_vocabulary(path), fn,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", ["doc_id"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the ids themselves (array of int)."""
    spec_b = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches):
        bpe = bpe_of(spec_b.value)
        for b in batches:
            ids = [bpe.encode(t or "").astype("i4") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        bpe.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, "doc_id long, ids array<int>")


def decode(ids: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the decoded text of rows (doc_id, ids)."""
    spec_b = ids.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches):
        bpe = bpe_of(spec_b.value)
        for b in batches:
            texts = [bpe.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    return token_digests(read_table(spark, sf_dir, "documents"))
