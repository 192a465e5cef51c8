import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from canvass.llm import language_id as L
from canvass.llm.catalog import QUERIES
from tests.llm.helpers import DOC, ODD, by_id, documents

TESTDATA = "/root/testdata/sf0.01"


def brute_logp(corpus, word):
    """Interpolated Kneser-Ney by its recursive definition."""
    n = L.ORDER
    counts = {n: Counter()}
    for w in corpus:
        s = L.START * (n - 1) + w + L.STOP
        counts[n].update(s[i : i + n] for i in range(len(s) - n + 1))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    v = len(counts[1]) + 1

    def p(k, gram):
        if not k:
            return 1 / v
        c = counts[k]
        n1, n2 = (sum(x == i for x in c.values()) for i in (1, 2))
        d = min(max(n1 / max(n1 + 2 * n2, 1), 0.1), 0.9)
        same = [x for g, x in c.items() if g[:-1] == gram[:-1]]
        if not same:
            return p(k - 1, gram[1:])
        return max(c[gram] - d, 0) / sum(same) + d * len(same) / sum(same) * p(k - 1, gram[1:])

    s = L.START * (n - 1) + word + L.STOP
    return sum(math.log(p(n, s[i : i + n])) for i in range(len(s) - n + 1))


def test_model_equals_recursive_definition():
    corpus = ["theater", "the", "then", "ether", "thin", "heat", "the", "anthem"]
    rows = pd.concat(L._count_grams(iter([pd.DataFrame({"text": corpus, "lang": "en"})])))
    m = L.build_model(rows, ["en"])
    words = ["the", "thea", "heather", "zzz", "t", "anthema", "ethéz"]
    total, size = m.word_scores(words)
    assert size.tolist() == [len(w) + 1 for w in words]
    np.testing.assert_allclose(total[:, 0], [brute_logp(corpus, w) for w in words], rtol=1e-5)


def test_probabilities_sum_to_one():
    rows = pd.concat(L._count_grams(iter([pd.DataFrame({"text": ["abcab bca cab ab a"], "lang": "x"})])))
    m = L.build_model(rows, ["x"])
    codes = lambda c: L._codes("^^^^a" + c)
    known = sum(math.exp(m.log_probs(codes(c), np.array([5]))[0, 0]) for c in "abc$")
    unknown = math.exp(m.log_probs(codes("q"), np.array([5]))[0, 0])
    assert math.isclose(known + unknown, 1.0, rel_tol=1e-5)


def test_trained_model_covers_rare_grams_of_a_large_corpus(spark):
    rare = ["xylem", "quiz", "fjord", "zephyr"]
    text = "the then there thin that other " * 10
    texts = [text + (rare[d // 400 % 4] if d % 400 < 2 else "") for d in range(4000)]
    fold = lambda d: zlib.crc32(str(d).encode())
    corpus = [w for d, t in enumerate(texts) if fold(d) % 4 != 2 and fold(d) // 4 % L.CALIBRATION for w in t.split()]
    assert sum(len(w) + 1 for w in corpus) > 600_000 and set(rare) <= set(corpus)
    m = L.train(documents(spark, texts))
    words = [*rare, "zephyrs", "thequiz"]
    np.testing.assert_allclose(m.word_scores(words)[0][:, 0], [brute_logp(corpus, w) for w in words], rtol=1e-5)


def test_held_out_accuracy_and_inputs(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    got = by_id(QUERIES["op1_language_id"](spark, TESTDATA))
    out = [d for d, r in got.items() if r.held_out]
    assert len(got) == len(truth) and 0.15 < len(out) / len(got) < 0.35
    right = defaultdict(list)
    for d in out:
        right[truth[d]].append(got[d].lang_pred == truth[d])
    assert all(np.mean(v) > 0.98 for v in right.values())
    assert np.mean([r.rejected for r in got.values()]) < 0.005
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark):
    train = [("the then there thin that this other " * 3, "en"), ("der die das und nicht sich eine " * 3, "de")] * 8
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate(train)]
    rows += [(100 + i, t, None, None, None) for i, t in enumerate(ODD)] + [(200, "123 ²½ !!", "en", "s", 1), (None, "the that", None, None, None)]
    docs = spark.createDataFrame(rows, DOC).withColumn("language", F.lit("clash")).withColumn("_p", F.lit(1))
    got = by_id(L.predict_languages(docs))
    assert got[100].lang_pred == got[101].lang_pred == got[200].lang_pred == "und"
    assert got[100].score == 0 and got[200].rejected and got[100].rejected
    assert got[None].lang_pred == "en" and not got[None].held_out
    assert got[103].lang_pred in ("en", "de")
    assert L.predict_languages(spark.createDataFrame([], DOC)).count() == 0
    unlabelled = L.predict_languages(documents(spark, ["the"], lang=None)).first()
    assert (unlabelled.lang_pred, unlabelled.score) == ("und", 0.0)


def test_gibberish_is_rejected(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    odd = spark.createDataFrame([(10**6 + i, "xqzv wqkj zzxq jjqx vvwk " * 20, None, None, 1) for i in range(3)], DOC)
    got = by_id(L.predict_languages(docs.unionByName(odd)).where("doc_id >= 1000000"))
    assert all(r.rejected for r in got.values())


def small_model():
    rows = []
    for lang, corpus in (("a", ["theater", "the", "then", "ether"]), ("b", ["sono", "casa", "cosa", "notte"])):
        rows += L._count_grams(iter([pd.DataFrame({"text": corpus, "lang": lang})]))
    return L.build_model(pd.concat(rows), ["a", "b"])


def test_long_texts_in_pieces_equal_whole(monkeypatch):
    text = "The then  cosa\nnotte é ether, theater sono\tΑΣ ΑΣ. " * 40
    whole, n = L.Scorer(small_model()).entropies([text, "casa"])
    monkeypatch.setattr(L, "PIECE", 37)
    assert "".join(L.pieces_of(text)) == text and max(map(len, L.pieces_of(text))) < 60
    assert list(L.pieces_of("x" * 99)) == ["x" * 99] and list(L.pieces_of("")) == [""]
    parts, m = L.Scorer(small_model()).entropies([text, "casa"])
    assert n.tolist() == m.tolist()
    np.testing.assert_allclose(parts, whole, rtol=1e-9)


def test_memory_of_words_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(L, "WORDS_BYTES", 20_000)
    s = L.Scorer(small_model())
    words = ["x" * 500 + "abcdefghij"[i % 10] * (i // 10 + 1) for i in range(100)]
    most = 0
    for w in words:
        s.entropies([w])
        most = max(most, sum(map(len, s.index)))
    assert most * 4 <= 25_000 and s.held < 25_000


def test_clashing_names_stay(spark):
    docs = documents(spark, ["the then", None]).withColumn("_p", F.lit("mine")).withColumn("_SCORE", F.lit(7))
    got = L.identify(docs).collect()
    assert {(r["_p"], r["_SCORE"]) for r in got} == {("mine", 7)}
