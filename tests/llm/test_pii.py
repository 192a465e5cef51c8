import functools
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from canvass.llm import pii as P
from canvass.llm.catalog import QUERIES
from tests.llm.helpers import DOC, ODD, by_id, documents

TESTDATA = "/root/testdata/sf0.001"


def brute_base(text):
    """The patterns as they are written."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c in "0123456789"]
        odd, even = d[::-1][::2], d[::-1][1::2]
        if 14 <= len(d) <= 19 and (sum(odd) + sum(sum(divmod(2 * x, 10)) for x in even)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    parts = ["a", "b_", "@", ".", "-", "+", "%", " ", "(", ")", "1", "25", "255", "999", "0", "x@y.z", "+1 (555) 123-4567", "4111111111111111", "10.0.0.1", "é", "\n", "٣"]
    for _ in range(20000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert P.base_spans(t) == brute_base(t), t
    for t in ("9" * 50000, "a" * 50000 + "@", "@" * 5000, "+1" * 3000, "1.2." * 3000):
        P.base_spans(t)


def test_query_base_counts_on_fixture(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    got = by_id(QUERIES["op5_pii"](spark, TESTDATA))
    assert len(got) == len(text)
    for d, t in text.items():
        base = brute_base(t or "")
        r = got[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        written = [f"{P.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",")) | {""} - {""} or not written


def exact_marginals(g, w):
    n = len(g.label)
    total = np.zeros((n, P.LABELS))
    u = w.unary[g.features].sum(1)
    for y in itertools.product(range(P.LABELS), repeat=n):
        if any(o >= 0 and o != v for o, v in zip(g.label, y)):
            continue
        s = sum(0.0 if g.label[i] >= 0 else u[i, v] for i, v in enumerate(y))
        s += sum(w.chain[y[a], y[b]] for a, b in g.chain) + sum(w.skip[y[a], y[b]] for a, b in g.skip)
        for i, v in enumerate(y):
            total[i, v] += np.exp(s)
    return total / total.sum(1, keepdims=True)


@pytest.mark.parametrize("text, exact", [("a1 b2 c c3", True), ("12 x 12 y 12", True), ("a1 a1 b2 b2", False)])
def test_messages_against_enumeration(text, exact):
    rng = np.random.default_rng(3)
    w = P.Field(rng.normal(size=(P.FEATURES, P.LABELS)) * 0.3, rng.normal(size=(5, 5)) * 0.5, np.eye(5))
    g = P.graph([text], [P.base_spans(text)])
    got, want = P.marginals(g, w), exact_marginals(g, w)
    np.testing.assert_allclose(got, want, atol=1e-3 if exact else 0.1)


def training_texts():
    rng = random.Random(1)
    for i in range(120):
        tail = f"{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        yield f"the word +1 ({rng.randint(200, 999)}) {tail} of then v{rng.randint(1, 9)}.0 and the {tail} of in"
        yield f"version {rng.randint(1, 9)}.{rng.randint(0, 9)} of {rng.randint(1900, 2024)} then on u{i}@mail.example.com the"


def test_skip_ties_spread_a_label_to_repeats(spark):
    docs = documents(spark, [*training_texts(), "call +1 (555) 867-5309 now", "call +1 (555) 867-5309 the of on in then 867-5309 of 2.0"])
    got = by_id(P.span_report(docs))
    spans = got[max(got)].spans.split(",")
    text = docs.where(F.col("doc_id") == max(got)).first().text
    assert [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in spans] == ["+1 (555) 867-5309", "867-5309"]
    assert all("version" not in text[int(s.split(":")[1]) :][:9] for s in spans)
    # the same number without the base match beside it has no such tie
    assert sum(len(r.spans.split(",")) for d, r in got.items() if d % 2 and d < 240) == 120


@pytest.mark.parametrize(
    "text",
    [
        "list +1 (555) 867-5309,10.0.0.1,867-5309,then",
        '{"tel":"+1 (555) 867-5309","ip":"10.0.0.1","short":"867-5309","v":"then"}',
        "电话+1 (555) 867-5309号码867-5309在",
    ],
)
def test_items_without_spaces_between_them(spark, text):
    docs = documents(spark, [*training_texts(), text])
    got = by_id(P.span_report(docs))
    spans = [s.split(":") for s in got[max(got)].spans.split(",")]
    assert [text[int(a) : int(b)] for k, a, b in spans if k == "phone"] == ["+1 (555) 867-5309", "867-5309"]


def test_shapes_and_labels_read_whole_tokens():
    assert P.shape("a" * 100 + "9" * 100 + ".") == "a9."
    assert P._features("x" * 70 + "1.2", "", "") != P._features("x" * 70 + "1-2", "", "")
    text = "+1 " + "1 " * 6 + "a@b.cd"  # many spans over and before one token
    many = [(0, 3, 14), *((0, 0, 1) for _ in range(20)), (15, 0, 21)]
    g = P.graph([text], [sorted(many)])
    assert g.label.tolist()[-1] == 1 and g.label.tolist()[1:-1] == [4] * 6


def test_a_rare_kind_is_trained_on(spark, monkeypatch):
    monkeypatch.setattr(P, "SAMPLE_DOCS", 20)
    plain = [f"version {i % 9}.{i % 7} of {1900 + i % 99} then on the" for i in range(600)]
    rare = [t for t in training_texts() if "+1" in t][:6]
    docs = documents(spark, [*plain, *rare, "call +1 (555) 867-5309 the of on in then 867-5309 of 2.0"])
    got = by_id(P.span_report(docs))
    text = docs.where(F.col("doc_id") == max(got)).first().text
    spans = got[max(got)].spans.split(",")
    assert [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in spans] == ["+1 (555) 867-5309", "867-5309"]
    assert all(got[d].spans == "" for d in range(len(plain)))


def test_sampled_tokens_come_from_the_whole_text():
    text = " ".join(f"{i}.5" for i in range(3000)) + " mail a@b.co or 10.0.0.1 then " + " ".join(f"{i}.7" for i in range(3000))
    g = P.graph([text], [P.base_spans(text)], P.SAMPLE_TOKENS)
    assert {1, 2} <= set(g.label.tolist()) and 0.9 * P.SAMPLE_TOKENS <= len(g.label) <= P.SAMPLE_TOKENS
    assert g.start.min() < len(text) / 4 and g.start.max() > len(text) * 3 / 4
    assert g.chain.max() < len(g.label) and (np.diff(g.chain, axis=1) == 1).all()
    whole = P.graph([text], [P.base_spans(text)])
    at = {a: i for i, a in enumerate(whole.start.tolist())}
    same = [at[a] for a in g.start.tolist()]
    assert (whole.features[same] == g.features).all() and (whole.label[same] == g.label).all()


def brute_fit(g, steps):
    """Gradient steps token by token."""
    y = np.maximum(g.label, 0)
    for a, b in g.skip:
        y[b] = y[a] if g.label[b] < 0 else y[b]
    n, prior = len(y), P.SAME * np.eye(P.LABELS)
    w = [np.zeros((P.FEATURES, P.LABELS)), np.zeros((P.LABELS, P.LABELS)), prior.copy()]
    sq = [np.full_like(x, 1e-8) for x in w]
    for _ in range(steps):
        s = w[0][g.features].sum(1)
        for a, b in g.chain:
            s[a] += w[1][:, y[b]]
            s[b] += w[1][y[a]]
        for a, b in g.skip:
            s[a] += w[2][y[b]]
            s[b] += w[2][y[a]]
        e = np.exp(s - s.max(1, keepdims=True))
        err = np.eye(P.LABELS)[y] - e / e.sum(1, keepdims=True)
        grad = [np.zeros_like(x) for x in w]
        for i, f in enumerate(g.features):
            for c in f:
                grad[0][c] += err[i]
        for a, b in g.chain:
            grad[1][:, y[b]] += err[a]
            grad[1][y[a]] += err[b]
        for a, b in g.skip:
            grad[2][y[b]] += err[a]
            grad[2][y[a]] += err[b]
        grad[2] = (grad[2] + grad[2].T) / 2
        for x, d, a, x0 in zip(w, grad, sq, (0, 0, prior)):
            d = d / n - 1e-3 * (x - x0) / n**0.5
            a += d**2
            x += 0.2 * d / np.sqrt(a)
    return w


def many_tokens():
    long = " ".join(f"{i}.5 10.0.0.{i % 256}, x{i % 7} of" for i in range(150)) + " +1 (555) 867-5309 or 867-5309 and 867-5309 by a@b.co"
    return [long, long, *list(training_texts())[:40], None, "no token"]


def test_training_takes_every_token_of_every_row(spark, monkeypatch):
    monkeypatch.setattr(P, "fit", functools.partial(P.fit, steps=12))
    texts = many_tokens()
    some = [t for t in texts if t]
    whole = P.graph(some, [P.base_spans(t) for t in some])
    assert len(whole.label) > 2 * 2 * P.SAMPLE_TOKENS
    w = P.train(documents(spark, texts))
    for got, want in zip((w.unary, w.chain, w.skip), brute_fit(whole, 12)):
        np.testing.assert_allclose(got, want, atol=1e-9)


def test_gradients_of_tasks_and_driver_are_the_same(spark, monkeypatch):
    docs = documents(spark, many_tokens()).repartition(3)
    counted = P.count_patterns(docs).collect()
    assert len({bytes(r.pattern) for r in counted}) == len(counted) < sum(r.n for r in counted) / 2
    monkeypatch.setattr(P, "fit", functools.partial(P.fit, steps=4))
    one = P.train(docs)
    monkeypatch.setattr(P, "IN_DRIVER", 0)
    other = P.train(docs)
    for a, b in ((one.unary, other.unary), (one.chain, other.chain), (one.skip, other.skip)):
        assert np.abs(a).max() > 0.1
        np.testing.assert_allclose(a, b, atol=1e-9)


def test_a_kind_is_learned_among_many_other_tokens():
    texts = [*list(training_texts())[:60], *(f"build {i}.5 of x{i}" for i in range(60))]
    g = P.graph(texts, [P.base_spans(t) for t in texts])
    p = P.patterns(g)
    plain = np.isin(g.doc, range(60, 120))
    n = np.where(plain, 1_000_000, 1)
    w = P.fit(lambda x: P.gradient(p, n, x), int(n.sum()))
    text = "call +1 (555) 867-5309 the of on in then 867-5309 of 2.0"
    assert [text[a:b] for a, k, b in P.find_spans([text], w)[0][1] if k == 3] == ["+1 (555) 867-5309", "867-5309"]


def test_odd_rows_and_mask(spark):
    docs = documents(spark, [*ODD, "a@b.co, +1 (555) 867-5309, on 10.0.0.1 x 4111 1111 1111 1111"]).withColumn("r", F.lit(1)).withColumn("h", F.lit("clash"))
    got = by_id(P.span_report(docs))
    assert got[0].spans == "" and got[0].n_email == 0 and got[len(ODD)].n_card == 1
    assert P.span_report(spark.createDataFrame([], DOC)).count() == 0
    out = by_id(docs.select("doc_id", "text", P.masked(F.col("text"), None).alias("m")))
    assert out[len(ODD)].m == "[EMAIL], [PHONE], on [IP] x [CARD]" and out[0].m is None
    assert all(r.m == r.text for i, r in out.items() if i < len(ODD))
