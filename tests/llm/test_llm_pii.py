"""Personal data: base spans against the plain patterns, messages against enumeration, repeats that the field adds."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aeris.llm import pii, skip_chain

SCHEMA = "doc_id long, text string, spans string, n_email int"


def plain(text):
    """The patterns as they are stated."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        total = sum(x if k % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for k, x in enumerate(d))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def found(text):
    return [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text or "")]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="0123456789.@+- ()ab%é\n5:", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert found(text) == plain(text)


CASES = ["a@b.c@d.e", "a@b@c.d", "1.2.3.45.6.7.8", "256.1.1.1 0255.1.1.01", "4111 1111 1111 1111", "4111-1111-1111-1112",
         "+1 (743) 555-3824.", "++12 345 678 90", "é@x.y é a.b+c@x-y.z.", "1.2.3", "", "x" * 300, "4" * 400, "1.1.1.1.1.1.1.1", "a@b..c", "@x.y"]


@pytest.mark.parametrize("text", CASES)
def test_single_cases(text):
    assert found(text) == plain(text)


def test_long_tokens_take_time_in_proportion():
    began = time.time()
    for text in ("1" * 400_000, "a" * 400_000, "1." * 200_000, "+" * 400_000, "a@" * 200_000, "1 " * 200_000, "+1" + " " * 400_000):
        spans = pii.base_spans(text)
        pii.units_of(text, spans)
    assert time.time() - began < 30


def random_graph(rng, tree):
    n = int(rng.integers(2, 6))
    chain = np.array([(k, k + 1) for k in range(n - 1)])
    skip = np.array([(0, n - 1)] if not tree and n > 2 else [], np.int64).reshape(-1, 2)
    g = skip_chain.Graph(rng.integers(0, 2, (n, 3)).astype(float), np.where(rng.random(n) < 0.3, rng.integers(0, 3, n), -1), chain, skip,
                         np.zeros(len(skip), np.int64))
    return g, skip_chain.Weights(rng.normal(size=(3, 3)), rng.normal(size=(3, 3)), np.array([0.5]))


def enumerated(g, w):
    p = np.zeros((len(g.features), 3))
    for y in itertools.product(range(3), repeat=len(g.features)):
        if any(k >= 0 and k != v for k, v in zip(g.label, y, strict=True)):
            continue
        s = sum(g.features[i] @ w.node[:, y[i]] for i in range(len(y)) if g.label[i] < 0)
        s += sum(w.chain[y[a], y[b]] for a, b in g.chain) + sum(w.skip[k] * (y[a] == y[b]) for (a, b), k in zip(g.skip, g.skip_kind, strict=True))
        for i, v in enumerate(y):
            p[i, v] += np.exp(s)
    return p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(20))
def test_messages_are_exact_without_loops_and_near_with_one(seed):
    rng = np.random.default_rng(seed)
    g, w = random_graph(rng, tree=seed % 2 == 0)
    assert np.abs(skip_chain.beliefs(g, w, 60) - enumerated(g, w)).max() < (1e-6 if seed % 2 == 0 else 0.15)


def test_gradient_by_differences():
    rng = np.random.default_rng(4)
    g, w = random_graph(rng, tree=False)
    truth, asked = rng.integers(0, 3, len(g.features)), rng.random(len(g.features)) < 0.8
    _, grad = skip_chain.pseudo_likelihood(g, truth, asked, w, 0.01)
    for name in ("node", "chain", "skip"):
        x, d = getattr(w, name), getattr(grad, name)
        for at in np.ndindex(x.shape):
            keep = x[at]
            values = []
            for e in (1e-5, -1e-5):
                x[at] = keep + e
                values.append(skip_chain.pseudo_likelihood(g, truth, asked, w, 0.01)[0])
            x[at] = keep
            assert abs((values[0] - values[1]) / 2e-5 - d[at]) < 1e-6


def luhn(rng):
    d = [rng.randint(0, 9) for _ in range(15)]
    total = sum(x if k % 2 else (2 * x if x < 5 else 2 * x - 9) for k, x in enumerate(reversed(d)))
    return "".join(map(str, [*d, -total % 10]))


def corpus(n, seed):
    rng, out = random.Random(seed), []
    for k in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(40)]
        kind = k % 6
        data = {0: f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}", 1: luhn(rng),
                2: f"{rng.choice(words)}.{rng.choice(words)}@site{k}.org", 3: ".".join(str(rng.randint(1, 255)) for _ in range(4))}.get(kind)
        again = None
        if data:
            digits = "".join(c for c in data if c.isdigit())
            again = {0: f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}", 1: ".".join(digits[j:j + 4] for j in range(0, 16, 4)),
                     2: data.split("@")[0], 3: data.replace(".", "-")}[kind]
            words[5], words[30] = data, again
        words[15] = str(rng.randint(1000, 10 ** 9))
        if kind == 5:
            words[10], words[20] = f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}", "2024"
        out.append((k, " ".join(words), data, again))
    return out


def test_field_adds_repeats_and_leaves_clean_texts_alone(spark):
    learn_from = [(i, t, "x", 1) for i, t, _, _ in corpus(600, 1)]
    fresh = corpus(240, 2)
    odd = [(None, None, None, None), (1000, "", "", 0), (1000, "", "", 0), (1001, "x 5 @", "", 0), (1002, ("+1 (743) 555-3824 or 743-555-3824 " * 2000), "", 0)]
    model = pii.fit(spark.createDataFrame(learn_from, SCHEMA))
    frame = spark.createDataFrame([*[(i, t, "x", 1) for i, t, _, _ in fresh], *odd], SCHEMA)
    rows = pii.find(frame, model).collect()
    assert len(rows) == len(fresh) + len(odd)
    got = {r["doc_id"]: r for r in rows}
    caught = clean = 0
    for i, text, data, again in fresh:
        base = plain(text)
        r = got[i]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        texts = [text[int(a):int(b)] for _, a, b in spans]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= {":".join(s) for s in spans}
        if data:
            caught += again in texts
            clean += set(texts) <= {data, again, *[text[a:b] for _, a, b in base]}
        else:
            clean += not spans
    assert caught >= 0.9 * sum(d is not None for _, _, d, _ in fresh)
    assert clean >= 0.97 * len(fresh)
    assert got[None]["spans"] == "" and got[None]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert len(got[1002]["spans"].split(",")) == 4000


def test_empty_and_without_data(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pii.fit(none) is None and pii.find(none, None).count() == 0
    plain_text = spark.createDataFrame([(1, "no data 12", "", 0)], SCHEMA)
    assert pii.fit(plain_text) is None
    assert pii.find(plain_text, None).first()["spans"] == ""
