import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canvass.llm import quality_rules as R
from canvass.llm.catalog import QUERIES
from tests.llm.helpers import DOC, ODD, documents

TESTDATA = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit), len(lines)


@given(st.lists(st.sampled_from(["a", "b", "c", " ", "\n", "\x0b", "\x85", " ", "é", "#", "<", "a b a b a b a "])).map(" ".join))
@settings(deadline=None, max_examples=200)
def test_measures_against_brute_force(text):
    assert R.measure(text) == plain_measures(text)


@pytest.mark.parametrize("k", [2, 3, 5, 6, 7])
def test_repeated_windows_of_any_length(k):
    rng = random.Random(k)
    for _ in range(60):
        words = [rng.choice([b"x", b"y"]) for _ in range(rng.randint(0, 40))]
        windows = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + k)}
        assert R.repeated_words(words, k) == len(hit)


def plain_bucket(v):
    drop = max(v.bit_length() - R.BITS, 0)
    return v >> drop << drop


def plain_rates(m):
    words, chars, symbols, dup, repeat, lines = m
    share = lambda n, of, scale: scale * n // of if of else 0
    return dict(zip(R.RATES, (share(chars, words, 100), share(symbols, chars, 10_000), share(dup, lines, 10_000), share(repeat, words, 10_000))))


def plain_limits(values, rate):
    v = sorted(map(plain_bucket, values))
    q = {p: v[max(0, -(-len(v) * p // 100) - 1)] for p in (5, 50, 95)}
    least = R.LEAST_SPREAD[rate]
    low = q[5] - R.REACH * max(q[50] - q[5], least) if rate in R.LOWER else -1
    return low, q[95] + R.REACH * max(q[95] - q[50], least)


def plain_verdicts(rows):
    """(doc_id, text, lang, source) -> measures, base_failed, kept."""
    found = [(d, lang, source, plain_measures(t)) for d, t, lang, source in rows]
    out = []
    for d, lang, source, m in found:
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        kept = not failed
        for rate, value in plain_rates(m).items() if kept else ():
            levels = [
                [x for x in found if x[3][0] and x[1] == lang and x[2] == source],
                [x for x in found if x[3][0] and x[1] == lang],
                [x for x in found if x[3][0]],
            ]
            group = next((g for g in levels[:2] if len(g) >= R.LEAST_DOCS), levels[2])
            low, high = plain_limits([plain_rates(x[3])[rate] for x in group], rate)
            kept &= low <= value <= high
        out.append((d, *m[:5], failed, kept))
    return sorted(out, key=repr)


def made_rows():
    rng = random.Random(11)
    words = ["the", "of", "onand", "thering", "es", "re", "and", "that", "inon", "er", "at", "wh"]
    long_words = [w * 5 for w in words]
    rows = []
    for i in range(420):
        lang, source = ("en", "a") if i < 150 else ("en", f"b{i % 7}") if i < 300 else ("fr", None) if i < 405 else (None, "z")
        text = " ".join(rng.choices(words if lang == "en" else long_words, k=rng.randint(11, 60)))
        if i % 40 == 7:
            text = text.replace("e", "#$%")  # out of line anywhere
        if i % 40 == 8:
            text = " ".join(rng.choices(long_words if lang == "en" else words, k=50))  # of the other language
        if i % 40 == 9:
            text = "\n".join(rng.choices(["same line of words here", "other line of words there"], k=9))
        rows.append((i, text, lang, source))
    return rows


def test_thresholds_and_verdicts_against_brute_force(spark):
    rows = made_rows() + [(1000 + i, t, "en", "a") for i, t in enumerate(ODD[:-1])] + [(7, "the of", None, None)] * 3
    docs = spark.createDataFrame([(d, t, lang, s, 0) for d, t, lang, s in rows], DOC).repartition(5)
    docs = docs.withColumn("group", F.lit("clash")).withColumn("rate", F.lit(1)).withColumn("n_words", F.lit(-1))
    got = R.judge_documents(docs)
    names = ["doc_id", *R.MEASURES[:5], "base_failed", "kept"]
    have = sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr)
    want = plain_verdicts(rows)
    assert have == want
    assert 5 < sum(not r[-1] and not r[-2] for r in want) < 60


def test_limits_differ_by_group_where_fixed_ones_would_not(spark):
    rows = {r.doc_id: r for r in R.judge_documents(spark.createDataFrame([(d, t, g, s, 0) for d, t, g, s in made_rows()], DOC)).collect()}
    assert not rows[8].kept and rows[8].failed == ["high word_length"]  # long words among English of the source
    assert not rows[328].kept and rows[328].failed == ["low word_length"]  # ordinary English words among the others


def test_hot_group_takes_the_spread_join(spark):
    """Limits beyond the broadcast threshold: the join's shuffle path."""
    docs = spark.createDataFrame([(d, t, g, s, 0) for d, t, g, s in made_rows()], DOC)
    plain = {r.doc_id: r.kept for r in R.judge_documents(docs).collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.canvass.skew.rowsPerTask", "20")
        assert {r.doc_id: r.kept for r in R.judge_documents(docs).collect()} == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.canvass.skew.rowsPerTask")


def test_sketches_merge_exactly(spark):
    rows = R.judge_documents(spark.read.parquet(f"{TESTDATA}/documents.parquet"))
    whole = {tuple(r) for r in R.sketch(rows, ["lang"]).collect()}
    assert {tuple(r) for r in R.merged(R.sketch(rows, ["lang", "source"]), ["lang"]).collect()} == whole


def test_query_keeps_ordinary_documents(spark):
    rows = QUERIES["op12_quality_rules"](spark, TESTDATA).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r[c] for c in R.MEASURES[:5]) == plain_measures(docs[r.doc_id])[:5]
    passed = [r for r in rows if not r.base_failed]
    assert sum(r.kept for r in passed) >= 0.95 * len(passed)  # the rest is lines of symbols and repeated lines


def test_long_text_and_empty_table(spark):
    assert R.measure("w " * 200_000)[4] == 200_000
    assert R.judge_documents(spark.createDataFrame([], DOC)).count() == 0
    assert not R.judge_documents(documents(spark, [None, ""])).where("kept").count()
