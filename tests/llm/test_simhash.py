import random

import pytest
import xxhash
from pyspark.sql import functions as F

from canvass.llm import simhash as S
from canvass.llm.catalog import QUERIES
from canvass.llm.components import connected_components
from tests.llm.helpers import DOC, ODD, by_id, documents

TESTDATA = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(prints, radius=4):
    comp = {i: i for i in prints}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(prints)
    for x in ids:
        for y in ids:
            if y > x and bin(prints[x] ^ prints[y]).count("1") <= radius:
                a, b = root(x), root(y)
                comp[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def check(got, texts):
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    comp = brute_components(prints)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == comp


@pytest.mark.parametrize("tile", [32768, 5])
def test_query_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(S, "TILE_ROWS", tile)
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()
    check(by_id(QUERIES["op8_simhash"](spark, TESTDATA)), {d.doc_id: d.text for d in docs})


def test_no_group_grows_with_the_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_ROWS", 20)
    monkeypatch.setattr(S, "TILE_MOST", 20)
    rng = random.Random(3)
    prints = list({rng.getrandbits(64) - (1 << 63) for _ in range(6000)})
    prints += [p ^ 1 << rng.randrange(63) for p in prints[:300]]
    df = spark.createDataFrame([(p,) for p in set(prints)], "fp long")
    groups = S.deal(df).groupBy("g").count().collect()
    assert max(r["count"] for r in groups) <= 5 * 20
    near = {tuple(sorted((p, q))) for p, q in zip(prints[:300], prints[-300:])}
    comp = {r.node: r.root for r in connected_components(S.simhash_links(df)).collect()}
    assert all(comp.get(p, p) == comp.get(q, q) for p, q in near)


def test_odd_texts(spark):
    docs = documents(spark, [*ODD, "   ", "A B c", "a\x0bb\x1cc d e f"]).withColumn("fp", F.lit("clash")).withColumn("u", F.lit(1))
    got = by_id(S.simhash_classes(docs))
    check(got, {r.doc_id: r.text for r in docs.collect()})
    assert S.simhash_classes(spark.createDataFrame([], DOC)).count() == 0
    twice = spark.createDataFrame([(None, "a b", None, None, None), (3, "a b", None, None, None), (3, "a b", None, None, None)], DOC)
    assert {r.component_id for r in S.simhash_classes(twice).collect()} == {3}


def test_links_connect_exactly_the_close_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_ROWS", 40)
    rng = random.Random(4)
    prints = set()
    for _ in range(60):
        p = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            prints.add(p)
            for _ in range(rng.randint(1, 4)):
                p ^= 1 << rng.randrange(64)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = S.simhash_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    root = {r.node: r.root for r in connected_components(links).collect()}
    want = brute_components({p: p & (1 << 64) - 1 for p in signed})
    assert {p: root.get(p, p) for p in signed} == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(40)] + [(7, 7), (3, 4), (4, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{100 + i: 100 for i in range(1, 40)}}


def test_every_pair_of_near_tiles_meets_once(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_ROWS", 15)
    monkeypatch.setattr(S, "TILE_MOST", 15)
    rng = random.Random(8)
    prints = {sum(1 << b for b in rng.sample(range(64), rng.choice([2, 3, 30, 31, 32, 33]))) for _ in range(500)}
    prints |= {0, 1, (1 << 64) - 1}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = S.deal(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    groups, met = {}, {}
    for r in rows:
        groups.setdefault(r.g, []).append(r)
    for rs in groups.values():
        assert len({(r.left, r.first) for r in rs}) == 1 and min(r.tile for r in rs) == rs[0].left
        mine = [r.fp for r in rs if r.tile == r.left]
        for q in rs:
            if q.tile != q.left or q.first:
                for p in mine:
                    pair = (min(p, q.fp), max(p, q.fp))
                    met[pair] = met.get(pair, 0) + (2 if q.tile != q.left or p == q.fp else 1)
    half = (1 << 32) - 1
    counts = {p: ((p & half).bit_count(), (p >> 32 & half).bit_count()) for p in signed}
    for p in signed:
        for q in signed:
            near = sum(abs(x - y) for x, y in zip(counts[p], counts[q])) <= S.RADIUS
            assert met.get((min(p, q), max(p, q)), 0) == (2 if near else 0)
