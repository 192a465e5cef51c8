import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from canvass.llm import ranked_search as S
from canvass.llm.catalog import ORACLE_SQL, QUERIES
from tests.llm.helpers import DOC, ODD, documents

TESTDATA = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEM = "item_id long, text string"


def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def plain_search(docs, items, k=50):
    """item -> list of (score, doc_id), the best first."""
    counts = [(d, Counter(t)) for d, t in ((d, plain_terms(t)) for d, t in docs) if t]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(plain_terms(text))
    out = {}
    for i, own in wanted.items():
        scored = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out[i] = [(-s, None if null else d) for s, null, d in sorted(scored)[:k]]
    return {i: v for i, v in out.items() if v}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r.score, r.doc_id))
        assert r["rank"] == len(out[r.item_id])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_full_evaluation(spark, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(400)]
    texts += [texts[3]] * 60 + ODD
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(25)]
    items += [(3, "more words w1"), (None, "w2 w3"), (None, "w9"), (90, None), (91, "  "), (92, "nowhere"), (93, "THE the ÉÉ héé 中文")]
    docs = documents(spark, texts).repartition(6).withColumn("score", F.lit("clash")).withColumn("term", F.lit(1))
    queries = spark.createDataFrame(items, ITEM).withColumn("doc_id", F.lit(5))
    want = plain_search(list(enumerate(texts)), items)
    assert found(S.search(docs, queries)) == want
    assert found(S.search(docs, queries, block_terms=20)) == want  # several blocks of queries
    few = {i: v[:3] for i, v in want.items()}
    assert found(S.search(docs, queries, k=3)) == few


def test_null_and_repeated_document_ids(spark):
    rows = [(None, "alpha beta"), (None, "alpha"), (2, "alpha"), (2, "alpha"), (1, "gamma"), (0, "alpha")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOC)
    got = found(S.search(docs, spark.createDataFrame([(7, "alpha beta")], ITEM)))
    assert got == plain_search(rows, [(7, "alpha beta")])
    assert [d for _, d in got[7]] == [None, 0, 2, 2, None]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC)
    items = spark.createDataFrame([(1, "word")], ITEM)
    assert S.search(none, items).count() == 0
    assert S.search(documents(spark, ["word"]), items.limit(0)).count() == 0
    assert S.search(documents(spark, [None, " ."]), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_accumulators_are_limited_and_results_are_not():
    """Common words create no accumulators once rare ones have filled the
    first places."""
    rng = np.random.default_rng(1)
    n = 5000
    common = np.ones(n, np.int64)
    rare = np.arange(0, n, 50)
    rows = np.concatenate([np.arange(n), rare])
    found_terms = np.concatenate([np.zeros(n, np.int64), np.ones(len(rare), np.int64)])
    order = np.argsort(rows, kind="stable")
    counts = np.bincount(rows, minlength=n)
    lengths = rng.integers(20, 80, n)
    times = np.concatenate([common, np.full(len(rare), 2)])
    part = S.Part(pa.array(range(n), pa.int64()), lengths, counts, found_terms[order], times[order], n, int(lengths.sum()))
    weights = {0: S.weight(n, n), 1: S.weight(n, len(rare))}
    score, open_rows = np.zeros(n, np.int64), np.zeros(n, bool)
    top, points = part.best([(1, weights[1]), (0, weights[0])], 50, score, open_rows)
    assert part.accumulators == len(rare) and not score.any() and not open_rows.any()
    full = np.zeros(n, np.int64)
    for t, w in weights.items():
        r, p = part.contributions(t, w)
        full[r] += p
    best = sorted(range(n), key=lambda i: (-full[i], i))[:50]
    assert top.tolist() == best and points.tolist() == full[best].tolist()


def test_query_against_duckdb(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TESTDATA}/{t}.parquet')")
    want = sorted(con.execute(ORACLE_SQL["op13_ranked_search"]).fetchall())
    got = sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in QUERIES["op13_ranked_search"](spark, TESTDATA).collect())
    assert got == want and got
