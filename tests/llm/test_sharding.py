import math
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from canvass.llm import sharding as S
from canvass.llm.catalog import QUERIES
from tests.llm.helpers import DOC, ODD, documents

TESTDATA = "/root/testdata/sf0.001"


def check(rows, texts):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert len(rows) == len(texts)


def test_query_holds_its_law(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()
    rows = QUERIES["op10_sharding"](spark, TESTDATA).collect()
    check(rows, docs)
    text = {d.doc_id: d.text for d in docs}
    for r in rows:
        b = (text[r.doc_id] or "").encode()
        assert r.size == len(b) + 1 and r.text_crc32 == zlib.crc32(b) and r.law == "key"


def test_odd_rows_repeats_and_hot_key(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_CHUNK", 7)
    docs = documents(spark, ODD).unionByName(spark.createDataFrame([(5, "same", "en", "s", 4)] * 50 + [(None, None, None, None, None)] * 9, DOC))
    docs = docs.withColumn("shard", F.lit("clash")).withColumn("_n", F.lit(2))
    rows = S.shard_documents(docs, 8).collect()
    check(rows, [0] * (len(ODD) + 59))
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1
    assert S.shard_documents(spark.createDataFrame([], DOC), 8).count() == 0


def test_weights_and_few_moves(spark):
    keys = spark.range(40000)
    w = [1.0, 2.0, 0.0, 5.0]
    rows = keys.select(
        S.rendezvous_shard(F.col("id"), w).alias("a"),
        S.rendezvous_shard(F.col("id"), [*w, 2.0]).alias("b"),
    ).collect()
    share = Counter(r.a for r in rows)
    assert share[2] == 0
    for i, x in enumerate(w):
        assert math.isclose(share[i] / 40000, x / 8, abs_tol=0.01)
    moved = [r for r in rows if r.a != r.b]
    assert all(r.b == 4 for r in moved) and math.isclose(len(moved) / 40000, 0.2, abs_tol=0.01)


def test_shards_equal_the_scores_computed_outside_spark(spark):
    """Highest of one draw per shard: XXH64 of the key, then of the shard's
    number under that seed, as a fraction between 0 and 1."""

    def shard(key, n):
        name = "\x00null" if key is None else str(key)
        seed = xxhash.xxh64_intdigest(name.encode(), seed=42)
        draws = [xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed=seed) >> 11 for i in range(n)]
        return draws.index(max(draws))

    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, "a"), (-5, "b"), (1 << 62, None)], "doc_id long, text string"))
    rows = S.shard_documents(docs, 8).collect()
    assert len(rows) == docs.count() and {r.shard for r in rows} == set(range(8))
    for r in rows:
        assert (r.shard, r.grown_shard) == (shard(r.doc_id, 8), shard(r.doc_id, 9))
