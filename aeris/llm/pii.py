r"""Personal data: base patterns, and further mentions of the same data by a skip-chain random field.

The base finds e-mail addresses, IP addresses, card and phone numbers by pattern and check digit.  A text often
mentions the same thing again in a form that no pattern takes: a phone number without its +, a card number with other
separators, an address without its domain.  Units (numbers, words with a digit or an @, user names of addresses
found) are the nodes of a random field: neighbours form a chain, and distant units with the same text,
the same last digits or the same user name are joined by skip edges, so that
message passing carries the labels of base spans to their repeats.  Of units that belong together each is
joined to the first base span among them, or else to the one before, never all with all.

No labels exist for such mentions, so they are made: in a bounded sample of ``SAMPLE`` texts with base spans, each
span is repeated in broken form (labelled), and twice with other digits or letters (labelled as
nothing); units of the text that are like one of its base spans are left out.  Shape alone therefore tells little and the skip edges decide.  A text without a
digit or an @ has no unit and costs one scan.

Defined cases: null text counts as empty (no span, digest of the empty string); a null doc_id is kept; repeated rows are judged one by
one; an empty table gives an empty result, and a corpus without base spans a model that adds nothing; patterns
take time in proportion to the text, however long its tokens; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import read_table
from aeris.llm.skip_chain import Graph, Weights, beliefs, learn

KINDS = ["email", "ip", "card", "phone"]
NOTHING = len(KINDS)
SAMPLE = 1500  # texts that the field learns from, at most
SAMPLE_UNITS = 60  # units of one of them, at most
LEAST_BELIEF = 0.6
TAIL = 7  # digits at the end that make two numbers alike
TOGETHER = 20_000  # units whose beliefs are found at a time, about
SAME, ALIKE, USER = 0, 1, 2  # kinds of skip edges

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# no digit may stand before: a match that starts inside a run of digits would start at its first one
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = " .,;:!?'\"<>[]{}"
_NUMBER = re.compile(r"[0-9+().,/_-]+")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str):
    """Leftmost addresses: for each @ the longest run of local characters before it, then a domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    if not _ANY.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group()) if m.end() - m.start() <= 40 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


@dataclass
class Unit:
    start: int
    end: int
    text: str
    label: int = -1  # of a base span


def units_of(text: str, spans: list[tuple[int, int, int]]) -> list[Unit]:
    """Base spans, and between them numbers (over single blanks), words with a digit or an @, and user names."""
    if not _ANY.search(text):
        return []
    taken = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if not taken or a >= taken[-1].end:
            taken.append(Unit(a, b, text[a:b], kind))
        else:  # spans of two kinds overlap: one unit, the earlier kind
            taken[-1].end = max(taken[-1].end, b)
    users = {u.text.partition("@")[0].lower() for u in taken if u.label == 0}
    users = {u for u in users if len(u) >= 5}
    out, at = [], 0
    for fixed in [*taken, Unit(len(text), len(text), "")]:
        for m in _TOKEN.finditer(text, at, fixed.start):
            token = m.group()
            if not _ANY.search(token):
                word = token.strip(_EDGE)
                if word.lower() in users:
                    start = m.start() + token.find(word)
                    out.append(Unit(start, start + len(word), word))
                continue
            number = _NUMBER.fullmatch(token.strip(_EDGE)) is not None
            a = m.start() + len(token) - len(token.lstrip(_EDGE))
            b = m.end() - (len(token) - len(token.rstrip(_EDGE)))
            if a >= b:
                continue
            last = out[-1] if out else None
            if number and last and last.label < 0 and last.end + 1 == a and text[last.end] == " " and _NUMBER.fullmatch(
                    last.text.replace(" ", "")) and len(last.text) < 64:
                last.end, last.text = b, text[last.start:b]
            else:
                out.append(Unit(a, b, text[a:b]))
        if fixed.text:
            out.append(fixed)
        at = fixed.end
    return out


_COUNTS = (0, 1, 3, 4, 5, 7, 9, 11, 13, 17)
_GROUPS = (1, 2, 3, 4, 5)
FEATURES = 1 + len(_COUNTS) + len(_GROUPS) + 8


def features(unit: str) -> np.ndarray:
    """Shape of a unit; the sign that makes a base phone number is not among it."""
    out = np.zeros(FEATURES)
    digits, groups = len(_digits(unit)), len(re.findall(r"[0-9]+", unit[:200]))
    out[0] = 1
    out[1 + max(k for k, n in enumerate(_COUNTS) if digits >= n)] = 1
    if groups:
        out[1 + len(_COUNTS) + max(k for k, n in enumerate(_GROUPS) if groups >= n)] = 1
    at = 1 + len(_COUNTS) + len(_GROUPS)
    out[at:] = ["@" in unit, "(" in unit, "-" in unit, "." in unit, " " in unit, any(c.isalpha() for c in unit), "/" in unit or "," in unit,
                digits == len(unit)]
    return out


def _keys(unit: str):
    """What makes units belong together: (kind of edge, key)."""
    low = unit.lower()
    yield SAME, low
    digits = _digits(unit)
    if len(digits) >= TAIL and len(digits) >= sum(c.isalnum() for c in unit):
        yield ALIKE, digits[-TAIL:]
    groups = re.findall(r"[0-9]+", low[:64])
    if len(groups) == 4 and len(digits) == sum(c.isalnum() for c in unit):
        yield ALIKE, ".".join(groups)
    user = low.partition("@")[0]
    if len(user) >= 5 and any(c.isalpha() for c in user):
        yield USER, user


def graph_of(documents: list[list[Unit]]) -> Graph:
    chain, skip, kinds, label, rows, base = [], [], [], [], [], 0
    for units in documents:
        groups: dict = {}
        for k, u in enumerate(units):
            rows.append(features(u.text))
            label.append(u.label)
            if k:
                chain.append((base + k - 1, base + k))
            for key in _keys(u.text):
                groups.setdefault(key, []).append(k)
        joined = set()
        for (kind, _), members in sorted(groups.items(), key=lambda x: x[0][0]):
            hub = next((k for k in members if units[k].label >= 0), None)
            for before, k in zip(members, members[1:], strict=False):
                ends = (min(hub, k), max(hub, k)) if hub is not None and k != hub else (before, k)
                if ends not in joined:
                    joined.add(ends)
                    skip.append((base + ends[0], base + ends[1]))
                    kinds.append(kind)
            if hub is not None and members[0] != hub and (members[0], hub) not in joined:
                joined.add((members[0], hub))
                skip.append((base + members[0], base + hub))
                kinds.append(kind)
        base += len(units)
    return Graph(np.array(rows).reshape(-1, FEATURES), np.array(label, np.int64), np.array(chain, np.int64).reshape(-1, 2),
                 np.array(skip, np.int64).reshape(-1, 2), np.array(kinds, np.int64))


def _broken(kind: int, unit: str, rng: random.Random) -> str | None:
    """The same thing in a form that no base pattern takes."""
    if kind == 0:
        user, _, domain = unit.partition("@")
        return rng.choice([user, f"{user}@{domain.split('.')[0]}"])
    digits = _digits(unit)
    if kind == 1:
        return unit.replace(".", rng.choice("-,/"))
    if kind == 2:
        mark = rng.choice("./")
        return mark.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    tail = digits[-10:] if len(digits) > 10 else digits[-TAIL:]
    return rng.choice([tail, f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", tail[-TAIL:]])


def _other(unit: str, rng: random.Random) -> str:
    """The same shape with other digits and letters."""
    return "".join(rng.choice("0123456789") if c.isdigit() else rng.choice("bcdfghjklmnp") if c.isalpha() else c for c in unit)


def training_graph(documents: list[list[tuple[str, int]]], seed: int = 3):
    """(graph, true labels, nodes to learn from) of the units (text, label or -1) of sampled texts."""
    rng, parts, truth, asked = random.Random(seed), [], [], []
    for units in documents:
        base = {key for t, k in units if k >= 0 for key in _keys(t)}
        # units like a base span may be repeats of it already: nothing is learned from them
        row = [(t, k, k if k >= 0 else NOTHING, k < 0) for t, k in units if k >= 0 or base.isdisjoint(_keys(t))]
        for t, kind in units:
            if kind >= 0:
                again = _broken(kind, t, rng)
                for text, want in ((again, kind), (_other(again, rng), NOTHING), (_other(again, rng), NOTHING)):
                    row.insert(rng.randrange(len(row) + 1), (text, -1, want, True))
        parts.append([Unit(0, 0, t, known) for t, known, _, _ in row])
        truth += [want for *_, want, _ in row]
        asked += [ask for *_, ask in row]
    return graph_of(parts), np.array(truth, np.int64), np.array(asked, bool)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Weights | None:
    """The field learned from ``sample`` texts with base spans at most, chosen by hash; None where no text has any."""
    def run(batches):
        for b in batches:
            texts, kinds, spots = [], [], []
            for t in b.column(0).to_pylist():
                spans = base_spans(t)
                if spans:
                    units = units_of(t, spans)[:SAMPLE_UNITS]
                    texts.append([u.text[:200] for u in units])
                    kinds.append([u.label for u in units])
                    spots.append(hashlib.sha256(t.encode("utf-8", "replace")).hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(spots, pa.string()), pa.array(texts, pa.list_(pa.string())),
                                              pa.array(kinds, pa.list_(pa.int32()))], ["spot", "units", "kinds"])

    rows = docs.select(F.col("text").cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]")).mapInArrow(
        run, "spot string, units array<string>, kinds array<int>")
    # one text for each of ``sample`` classes of the hash, the least of it: tasks and the driver hold that many rows at most
    rows = sorted(r["t"] for r in rows.groupBy(F.pmod(F.xxhash64("spot"), F.lit(sample))).agg(
        F.min(F.struct("spot", "units", "kinds")).alias("t")).collect())
    if not rows:
        return None
    graph, truth, asked = training_graph([list(zip(r["units"], r["kinds"], strict=True)) for r in rows])
    return learn(graph, truth, asked, len(KINDS) + 1, 3)


def added_spans(documents: list[list[Unit]], model: Weights | None, least: float = LEAST_BELIEF) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) of the units that the field labels, for each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    flat = [(d, u) for d, units in enumerate(documents) for u in units]
    if not flat or model is None:
        return out
    found = beliefs(graph_of(documents), model)
    best = found.argmax(axis=1)
    for k in np.flatnonzero((best != NOTHING) & (found.max(axis=1) >= least)).tolist():
        d, u = flat[k]
        if u.label < 0:
            out[d].append((int(best[k]), u.start, u.end))
    return out


def _listed(spans) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)])


_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])


def find(docs: DataFrame, model: Weights | None) -> DataFrame:
    """doc_id, base spans by kind, the digest of base spans, and all spans, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            spans = [base_spans(t or "") for t in texts]
            more: list = [()] * len(texts)
            held, size = [], 0
            for k, t in enumerate(texts):
                units = units_of(t or "", spans[k])
                if any(u.label < 0 for u in units):
                    held.append((k, units))
                    size += len(units)
                if held and (size >= TOGETHER or k == len(texts) - 1):
                    for (i, _), got in zip(held, added_spans([u for _, u in held], shared.value), strict=True):
                        more[i] = got
                    held, size = [], 0
            cols = [b.column(0), *[pa.array([sum(s[0] == k for s in own) for own in spans], pa.int64()) for k in range(len(KINDS))],
                    pa.array([hashlib.sha256(_listed(own).encode()).hexdigest() for own in spans]),
                    pa.array([_listed([*own, *got]) for own, got in zip(spans, more, strict=True)], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, schema=_SCHEMA)

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, {kinds}, base_sha256 string, spans string")


def op13_pii(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, fit(docs))
