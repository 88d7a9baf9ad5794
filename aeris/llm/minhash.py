"""Near-duplicate texts: BagMinHash signatures over the multiset of five-word shingles.

A shingle that occurs w times has weight w.  Weights are discretised into
unit levels and the levels are arranged in strips [0, 1), [1, 2), [2, 4), [4, 8) ..., each with a
Poisson process of its own (seeded by shingle and strip, its rate the strip's width); a
point names a register and a level and counts where the level lies below the weight.  A
register keeps its earliest point, so two texts agree in a register with a probability equal to
their weighted Jaccard similarity.  Points are drawn in the order of time, stretch by stretch, and a text's processes end with
the stretch that fills its last register.

Signatures are cut into ``BANDS`` of ``ROWS`` registers.  Two texts are candidates if they share a band and
agree in ``LIKELY`` registers (a pair of similarity 0.8 falls short of that with a probability of 1e-7); one
byte of each register is enough to see that, so texts without a candidate are never fetched.  Texts with the same words are one class, and
buckets with the same members one bucket.  Within a bucket every member is compared with a pivot, and
exact multiset overlap decides; members that are not connected yet are compared with the member that shares
most buckets, then with others.  What is still open after ``PIVOTS`` rounds is compared in
blocks: a unit of work holds two blocks of a bucket and reports a spanning forest of the links between members
that were not connected, never the pairs.  So every two classes that share a bucket are either compared
or already connected.

Vertices, bucket members and join keys are classes, named by a 64-bit hash of their words; doc_ids only come in
at the end, where a group is named by the smallest one of its rows.  Different texts under one doc_id, or
without one, are thus told apart.

Words are runs of characters other than blank and U+0009..U+000D, taken as they are; a text of fewer than
five words is one shingle.  Defined cases: a null text or one without words is a group of its own; of each group
the class with the smallest doc_id (then digest) stays, so rows that repeat doc_id and words share their verdict;
a null doc_id counts as the largest id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import Scratch, connected_components, materialize, read_table, shuffle_files_removed, whole_rows, whole_text
from aeris.llm.hashing import mix, shingle_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 5
BANDS = 30
PIVOTS = 1
LIKELY = 94  # of the 150 registers
BLOCK = 256  # members of a bucket compared with one another in one unit, about
BLOCK_BYTES = 1 << 24
MARKS = 1 << 26  # bits of the map that tells texts without a candidate
_COLUMNS = 1 << 13  # shingles that a comparison takes at a time
TOP = (1 << 63) - 1
_STRETCH, _FIRST = 0.5, 8  # stretches of time, in mean waits for a register, and how many are drawn before the first look
_TOGETHER = 1 << 15  # shingles whose points are drawn together, at least
_BATCH = 1 << 24  # bytes of shingles in a batch, about


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes in order, how often each occurs)."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return np.unique(shingle_hashes(word_hashes(raw), SHINGLE), return_counts=True)


def _times(constant: int, k: int) -> np.uint64:
    return np.uint64(constant * k & 0xFFFFFFFFFFFFFFFF)


def _points(seed: np.ndarray, k: np.ndarray, registers: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k-th point of each process: waiting time at rate 1, register, level in [0, 1), name."""
    name = mix(seed + np.uint64(0x9E3779B97F4A7C15) * (k + 1).astype(np.uint64))
    other = mix(name ^ np.uint64(0xD1B54A32D192ED03))
    wait = -np.log(((name >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53)
    register = ((other >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
    level = (other & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0 ** 32
    return wait, register.astype(np.int64), level, name


def _strips(found: np.ndarray, weights: np.ndarray, owner: np.ndarray):
    """The processes of some shingles: (seed, start and width of the strip, weight, owner)."""
    out, strip, start, width = [], 0, 0, 1
    while len(found):
        n = len(found)
        out.append((mix(found + _times(0xA0761D6478BD642F, strip)), np.full(n, start), np.full(n, width), weights, owner))
        strip, start, width = strip + 1, start + width, start + width
        more = weights > start
        found, weights, owner = found[more], weights[more], owner[more]
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def bag_minhashes(bags: list[tuple[np.ndarray, np.ndarray]], registers: int) -> list[np.ndarray]:
    """For each bag the names of the earliest points, one for each register (none for an empty bag).

    Time goes on in stretches.  A process rests while its next point lies beyond the present one, and all processes of a bag
    end with the stretch in which its last register is filled: later points could not change it.
    """
    todo = [k for k, (x, _) in enumerate(bags) if len(x)]
    names = [np.zeros(0, np.uint64)] * len(bags)
    if not todo:
        return names
    owner = np.repeat(np.arange(len(todo)), [len(bags[k][0]) for k in todo])
    seed, start, width, limit, owner = _strips(np.concatenate([bags[k][0] for k in todo]),
                                               np.concatenate([bags[k][1] for k in todo]), owner)
    rate = registers * width.astype(np.float64)
    stretch = _STRETCH / np.array([float(bags[k][1].sum()) for k in todo])
    until = _FIRST * stretch
    table, filled = np.zeros((len(todo), registers), np.uint64), np.zeros((len(todo), registers), bool)
    count = np.zeros(len(seed), np.int64)
    wait, register, level, name = _points(seed, count, registers)
    time = wait / rate
    while len(seed):
        due, got = np.flatnonzero(time <= until[owner]), []
        while len(due):
            counts = due[(start[due] + np.floor(level[due] * width[due]) < limit[due]) & ~filled[owner[due], register[due]]]
            got.append((owner[counts] * registers + register[counts], time[counts], name[counts]))
            count[due] += 1
            wait, register[due], level[due], name[due] = _points(seed[due], count[due], registers)
            time[due] += wait / rate[due]
            due = due[time[due] <= until[owner[due]]]
        if got:
            cell, at, found = (np.concatenate(x) for x in zip(*got, strict=True))
            latest_first = np.argsort(-at, kind="stable")
            table.reshape(-1)[cell[latest_first]] = found[latest_first]  # the earliest point is written last
            filled.reshape(-1)[cell] = True
        until += stretch
        live = ~filled.all(axis=1)[owner]
        if not live.all():
            seed, start, width, limit, owner, rate, count, time, register, level, name = (
                x[live] for x in (seed, start, width, limit, owner, rate, count, time, register, level, name))
    for j, k in enumerate(todo):
        names[k] = table[j]
    return names


def band_names(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(bands, rows)
    acc = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        acc = mix(acc * np.uint64(0x2545F4914F6CDD1D) + parts[:, k])
    return acc.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    either = int(a[1].sum()) + int(b[1].sum()) - both
    return both / either if either else 0.0


def words_key(text: Column) -> Column:
    """Digest of the words of a text, null if it has none."""
    words = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return F.when(F.length(words) > 0, F.sha2(words, 256))


def class_id(key: Column) -> Column:
    """Name of a text class in links, buckets and joins."""
    return F.xxhash64(key)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bands, sketch) of every row; all but doc_id are null for texts without words.

    ``sketch`` has the low byte of each register.
    """
    def run(batches):
        for b in batches:
            bands, sketches, bags, held, known = [], [], [], 0, {}
            keys = b.column("key").to_pylist()
            place = [known.setdefault(k, len(known)) for k in keys]  # a text class is signed once in a batch
            first = {}
            for k, p in enumerate(place):
                first.setdefault(p, k)
            for p in range(len(known)):
                bags.append(shingles(b.column("_text")[first[p]].as_py()))
                held += len(bags[-1][0])
                if held >= _TOGETHER or p == len(known) - 1:
                    for sig in bag_minhashes(bags, BANDS * ROWS):
                        bands.append(band_names(sig, BANDS, ROWS) if len(sig) else None)
                        sketches.append(sig.astype(np.uint8).tobytes() if len(sig) else None)
                    bags, held = [], 0
            bands, sketches = [bands[p] for p in place], [sketches[p] for p in place]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(bands, pa.list_(pa.int64())),
                                              pa.array(sketches, pa.binary())], ["doc_id", "key", "bands", "sketch"])

    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(TOP)).alias("doc_id"),
                       words_key(whole_text()).alias("key"), whole_text().alias("_text")).mapInArrow(
        run, "doc_id long, key string, bands array<long>, sketch binary")


def _marks(wanted: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the hashes of ``wanted`` (id, rep): 2048 rows of 4 KB at most reach the driver."""
    spot = F.pmod(F.xxhash64("id", "rep"), F.lit(MARKS))
    rows = wanted.groupBy(F.floor(spot / 32768).cast("long").alias("page")).agg(
        F.bitmap_construct_agg(spot % 32768).alias("bits")).collect()
    out = np.zeros(MARKS // 8, np.uint8)
    for r in rows:
        out[r["page"] * 4096:(r["page"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _bags(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, bag) of the classes in ``wanted`` (id, smallest doc_id): shingles and counts as bytes.

    The bitmap spares most other texts and copies the work; the join decides.  Texts are not shuffled, bags are,
    one of a class from each task at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_marks(wanted))

    def run(batches):
        marks, ids, bags, held, done = shared.value, [], [], 0, set()

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bags, pa.binary())], ["id", "bag"])

        for b in batches:
            spot = b.column(2).to_numpy()
            for k in np.flatnonzero(marks[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).tolist():
                own = b.column(0)[k].as_py()
                if own in done:
                    continue
                done.add(own)
                found, counts = shingles(b.column(1)[k].as_py())
                if len(found):
                    ids.append(own)
                    bags.append(found.tobytes() + counts.astype(np.int32).tobytes())
                    held += len(bags[-1])
                if held >= _BATCH:
                    yield batch()
                    ids, bags, held = [], [], 0
        if ids:
            yield batch()

    rep = F.coalesce(F.col("doc_id").cast("long"), F.lit(TOP))
    texts = docs.select(class_id(words_key(whole_text())).alias("id"), whole_text().alias("t"), rep.alias("rep"))
    made = texts.select("id", "t", F.pmod(F.xxhash64("id", "rep"), F.lit(MARKS)).alias("spot")).mapInArrow(
        run, "id long, bag binary")
    return made.join(wanted, "id", "left_semi").dropDuplicates(["id"])


def _bag(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 12
    return np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.int32, n, n * 8)


def _verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose bags overlap enough."""
    def run(batches):
        for b in batches:
            keep = [overlap(_bag(x.as_py()), _bag(y.as_py())) >= similarity for x, y in zip(*b.columns[2:], strict=True)]
            yield pa.RecordBatch.from_arrays(list(b.columns[:2]), ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = pairs.join(bags.select(F.col("id").alias("a"), F.col("bag").alias("x")), "a").join(
        bags.select(F.col("id").alias("b"), F.col("bag").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()


def _compare(bags: list[tuple[np.ndarray, np.ndarray]], similarity: float) -> np.ndarray:
    """Which bags overlap enough, all against all: shared (shingle, level) cells are counted by a matrix product."""
    owner = np.repeat(np.arange(len(bags)), [int(c.sum()) for _, c in bags])
    cells = np.concatenate([mix(np.repeat(x, c) + _levels(c)) for x, c in bags])
    _, cell, seen = np.unique(cells, return_inverse=True, return_counts=True)
    common = seen[cell] > 1
    place = np.cumsum(seen > 1) - 1
    owner, cell = owner[common], place[cell[common]]
    order = np.argsort(cell, kind="stable")
    owner, cell = owner[order], cell[order]
    both = np.zeros((len(bags), len(bags)), np.float32)
    for low in range(0, int(cell[-1]) + 1 if len(cell) else 0, _COLUMNS):
        a, b = np.searchsorted(cell, (low, low + _COLUMNS))
        table = np.zeros((len(bags), _COLUMNS), np.float32)
        table[owner[a:b], cell[a:b] - low] = 1
        both += table @ table.T
    size = np.array([float(c.sum()) for _, c in bags])
    return both >= similarity * (size[:, None] + size[None, :] - both)


def _levels(counts: np.ndarray) -> np.ndarray:
    """0 .. c - 1 for each count c, spread over the 64-bit numbers."""
    at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return at.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` vertices the smallest one that the pairs connect it with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            return root


def _in_blocks(rows: DataFrame, blocks: DataFrame, cols: list[str]) -> DataFrame:
    """``rows`` of each bucket dealt to units of two blocks: band, bi, bj and ``cols``; ``blocks`` (band, blocks)."""
    return rows.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", F.least("block", "_other").alias("bi"), F.greatest("block", "_other").alias("bj"), *cols)


def _sketches(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)


def _with_candidates(live: DataFrame, sketches: DataFrame) -> DataFrame:
    """(band, id) of the members of a bucket that have a candidate in it."""
    blocks = live.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    units = _in_blocks(live.join(sketches, "id"), blocks, ["id", "sketch"])
    keys = ["band", "bi", "bj"]

    def run(batches):
        key, held, found = None, [], []

        def close():
            s = _sketches([h[1] for h in held])
            for a in range(0, len(s), 64):
                agree = (s[a:a + 64, None, :] == s[None, :, :]).sum(axis=2) >= LIKELY
                agree[np.arange(len(agree)), np.arange(a, a + len(agree))] = False
                found.extend((key[0], held[a + k][0]) for k in np.flatnonzero(agree.any(axis=1)))

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found, strict=True)], ["band", "id"])

        for b in batches:
            for *own, i, sketch in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if own != key:
                    if len(held) > 1:
                        close()
                    key, held = own, []
                held.append((i, sketch))
            if found:
                yield batch()
                found.clear()
        if len(held) > 1:
            close()
        if found:
            yield batch()

    return units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "band long, id long").distinct()


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that agree in enough registers."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                keep = (_sketches(b.column(2).to_pylist()) == _sketches(b.column(3).to_pylist())).sum(axis=1) >= LIKELY
                yield pa.RecordBatch.from_arrays(list(b.columns[:2]), ["a", "b"]).filter(pa.array(keep))

    full = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("x")), "a").join(
        sketches.select(F.col("id").alias("b"), F.col("sketch").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _open_links(placed: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between the parts that are left in each bucket (band, id, part)."""
    full = placed.join(bags, "id")
    blocks = full.groupBy("band").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.octet_length("bag")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    units = _in_blocks(full, blocks, ["id", "part", "bag"])
    keys = ["band", "bi", "bj"]

    def run(batches):
        key, held = None, []

        def close():
            parts = np.array([h[1] for h in held])
            if len(held) < 2 or (parts == parts[0]).all():
                return None
            close_by = _compare([_bag(h[2]) for h in held], similarity) & (parts[:, None] != parts[None, :])
            a, b = np.nonzero(np.triu(close_by, 1))
            root = _forest(a, b, len(held))
            ids, at = np.array([h[0] for h in held], np.int64), np.flatnonzero(root != np.arange(len(held)))
            return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[root[at]])], ["a", "b"]) if len(at) else None

        for b in batches:
            for *own, i, part, bag in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if own != key:
                    if (out := close() if held else None) is not None:
                        yield out
                    key, held = own, []
                held.append((i, part, bag))
        if (out := close() if held else None) is not None:
            yield out

    return units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, similarity: float = SIMILARITY, kept: list[str] | None = None) -> DataFrame:
    """(doc_id, key, group_id, kept) for every row of ``docs``; doc_id TOP stands for null.

    The one table that the result reads is named in ``kept``; what was written on the way is deleted.
    """
    with shuffle_files_removed(docs.sparkSession), Scratch(docs.sparkSession, kept) as made:
        return made.keep(_groups(docs, similarity), "groups")


def _groups(docs: DataFrame, similarity: float) -> DataFrame:
    rows = materialize(signatures(docs), "signatures")
    classes = materialize(rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first(F.struct("bands", "sketch")).alias("s")).select(
        "key", class_id(F.col("key")).alias("id"), "rep", "s.*"), "text-classes")
    entries = classes.select("id", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y")).filter("n > 1")
    apart = shared.groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band")
    sketches = classes.select("id", "sketch")
    near = materialize(_with_candidates(materialize(entries.join(apart, "band"), "buckets"), sketches), "candidates")
    members = materialize(near.join(near.groupBy("id").agg(F.count(F.lit(1)).alias("weight")), "id"), "members")
    wanted = materialize(classes.select("id", "rep").join(near.select("id").distinct(), "id", "left_semi"), "wanted")
    bags = materialize(_bags(docs, wanted), "bags")

    pivots = near.groupBy("band").agg(F.min("id").alias("pivot"))
    tested = materialize(_ordered(near.join(pivots, "band"), "id", "pivot"), "pairs-0")
    links = materialize(_verified(_likely(tested, sketches), bags, similarity), "links-0")
    parts = materialize(connected_components(links, "texts-0"), "parts-0")
    for k in range(1, PIVOTS + 1):
        placed = members.join(parts, "id", "left").select("band", "id", "weight", F.coalesce("component", "id").alias("part"))
        order = -F.col("weight") if k == 1 else F.xxhash64(F.lit(k), "id")
        split = placed.groupBy("band").agg(
            F.min("part").alias("low"), F.max("part").alias("high"),
            F.min_by(F.struct(F.col("id").alias("pivot"), F.col("part").alias("home")), F.struct(order, "id")).alias("p")).filter("low <> high")
        # whole buckets leave as soon as all their members are connected
        placed = materialize(placed.join(split.select("band", "p.pivot", "p.home"), "band"), f"open-{k}")
        pairs = placed.filter("part <> home").select("id", "pivot")
        fresh = materialize(_ordered(pairs, "id", "pivot").join(tested, ["a", "b"], "left_anti"), f"pairs-{k}")
        members = placed.select("band", "id", "weight")
        if fresh.isEmpty():
            continue
        tested, links = tested.union(fresh), links.union(
            materialize(_verified(_likely(fresh, sketches), bags, similarity), f"links-{k}"))
        parts = materialize(connected_components(links, f"texts-{k}"), f"parts-{k}")
    placed = members.join(parts, "id", "left").select("band", "id", F.coalesce("component", "id").alias("part"))
    split = placed.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high")
    rest = materialize(_open_links(materialize(placed.join(split.select("band"), "band"), "open"), bags, similarity), "links")
    if not rest.isEmpty():
        parts = materialize(connected_components(links.union(rest), "texts"), "parts")
    linked = classes.select("key", "id", "rep").join(parts, "id")
    first = linked.groupBy("component").agg(F.min(F.struct("rep", "key")).alias("first"))
    owner = linked.join(first, "component").select("id", "first")
    owner = classes.select("key", "id", "rep").join(owner, "id", "left").select(
        "key", F.coalesce("first.rep", "rep").alias("group_id"), F.coalesce("first.key", "key").alias("_stays"))
    return rows.select("doc_id", "key").join(owner, "key", "left").select(
        "doc_id", "key", F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce((F.col("doc_id") == F.col("group_id")) & (F.col("key") == F.col("_stays")), F.lit(True)).alias("kept"))


def dedup(docs: DataFrame, similarity: float = SIMILARITY, kept: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, all columns unchanged."""
    stay = groups(docs, similarity, kept).filter("kept").select(
        F.col("doc_id").alias("_id"), F.coalesce("key", F.lit("")).alias("_key")).distinct()
    text = F.coalesce(F.col("_row.text").cast("string"), F.lit(""))
    marked = whole_rows(docs).withColumn("_id", F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(TOP))).withColumn(
        "_key", F.coalesce(words_key(text), F.lit("")))
    return marked.join(stay, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"]).select("_row.*")


def op2_minhash(spark, sf_dir: str) -> DataFrame:
    found = groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    real = F.nullif(F.col("doc_id"), F.lit(TOP))
    return found.select(real.alias("doc_id"), F.nullif(F.col("group_id"), F.lit(TOP)).alias("group_id"), "kept")
