import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from canvass.llm import decontaminate as D
from canvass.llm.catalog import QUERIES
from tests.llm.helpers import DOC, ODD, documents

TESTDATA = "/root/testdata/sf0.01"


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_lcs_against_table():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert D.lcs_length(D.masks(a), b) == brute_lcs(a, b)


def brute_verify(item, words):
    """Every stretch, one by one."""
    n, size, end = len(item), D.stretch(len(item)), item[-D.ANSWER :]
    found = []
    for i in range(max(1, len(words) - size + 1)):
        part = words[i : i + size]
        k, answer = brute_lcs(item, part), brute_lcs(end, part) >= 0.75 * len(end)
        if k >= D.least_of(n) and (k >= D.LCS * n or answer):
            found.append((k / n, answer))
    return max(found, default=None)


def test_verify_against_every_stretch():
    rng = random.Random(2)
    for _ in range(250):
        item = [rng.choice("abcdefghij") + rng.choice("xy") for _ in range(rng.randint(1, 30))]
        words = [rng.choice(item) if rng.random() < 0.3 else rng.choice("abcdefghij") for _ in range(rng.randint(0, 90))]
        kept = [x for x in item if rng.random() > 0.25]
        at = rng.randint(0, len(words))
        region = words[:at] + kept + words[at:]
        assert D.verify(item, region) == brute_verify(item, region)


def spread_leaks(rng, n, width, count):
    """Documents with exactly 0.80 of an item's words in order, the first and
    the last of them at the ends of a stretch of ``width`` words."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    items, texts = [], []
    for _ in range(count):
        item = [word() for _ in range(n)]
        kept = [item[i] for i in sorted(rng.sample(range(n), round(0.8 * n)))]
        inside = sorted(rng.sample(range(1, width - 1), len(kept) - 2))
        span = [word() for _ in range(width)]
        for place, w in zip([0, *inside, width - 1], kept):
            span[place] = w
        before, after = ([word() for _ in range(rng.randint(0, 90))] for _ in range(2))
        items.append(" ".join(item))
        texts.append(" ".join(before + span + after))
    return texts, items


def test_leaks_that_fill_their_stretch_are_found(spark):
    rng = random.Random(4)
    texts, items = [], []
    for n, width in ((20, 32), (20, 30), (10, 17), (20, 28), (10, 15), (8, 14), (30, 47)):
        t, x = spread_leaks(rng, n, min(width, D.stretch(n)), 40)
        texts, items = texts + t, items + x
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.leaks(documents(spark, texts), benchmark).collect()}
    assert got >= {(i, i) for i in range(len(items)) if round(0.8 * len(items[i].split())) >= 0.8 * len(items[i].split())}


def brute_leaks(texts, items):
    """Every stretch of every text against every item, without a search."""
    out = set()
    for d, t in texts.items():
        w = D.words_of(t)
        for i, x in items.items():
            item = D.words_of(x)
            if item and D.verify(item, w):
                out.add((d, i))
    return out


def test_query_recall_and_precision(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()}
    want = brute_leaks(texts, items)
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, TESTDATA).collect()}
    verbatim = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert verbatim and verbatim <= got
    assert got <= want and len(got) >= 0.9 * len(want)


def test_paraphrases_are_found_and_others_left(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    items = [[word() for _ in range(rng.randint(10, 130))] for _ in range(12)]
    rows = []
    for d in range(300):
        w = [word() for _ in range(rng.randint(30, 300))]
        if d < 24:
            item = [x if rng.random() > 0.15 or k > len(items[d % 12]) - 5 else word() for k, x in enumerate(items[d % 12])]
            w[10:10] = item
        if 24 <= d < 36:
            w[5:5] = rng.sample(items[d - 24], len(items[d - 24]) // 3)
        rows.append((d, " ".join(w), "en", "s", 1))
    docs = spark.createDataFrame(rows, DOC).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}
    assert got <= {(d, d % 12) for d in range(24)} and len(got) >= 22


def test_item_that_is_all_over_the_corpus(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    item = [word() for _ in range(20)]
    other = [word() for _ in range(20)]
    rows = [(d, " ".join([word() for _ in range(80)] + (item if d % 3 == 0 else []) + [word() for _ in range(30)]), "en", "s", 1) for d in range(300)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other)), (3, None), (4, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.leaks(spark.createDataFrame(rows, DOC), bench).collect()}
    assert got == {(d, 1) for d in range(0, 300, 3)}


def test_paraphrase_in_a_third_of_the_documents(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    item = [word() for _ in range(30)]
    near = [word() if k in (3, 8, 13, 18, 23) else w for k, w in enumerate(item)]
    rows = [(d, " ".join([word() for _ in range(80)] + (near if d % 3 == 0 else []) + [word() for _ in range(30)]), "en", "s", 1) for d in range(300)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame(rows, DOC)
    assert {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()} == {(d, 1) for d in range(0, 300, 3)}
    assert D.without_leaks(docs, bench).count() == 200


def test_short_items_among_other_words_of_the_block(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(6000)]
    items = [" ".join(rng.sample(words, rng.randint(5, 12))) for _ in range(600)]
    texts = [" ".join([*rng.sample(words, 40), items[d], *rng.sample(words, 40)]) for d in range(300)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in D.leaks(documents(spark, texts), bench).collect()]
    assert sorted(got) == [(d, d) for d in range(300)]


def test_blocks_odd_rows_and_empty_tables(spark, monkeypatch):
    bench = spark.createDataFrame([(7, "the ererwh onthend an thinore the ererwh onthend an"), (8, "zz yy xx ww vv uu tt ss")], "item_id long, text string")
    docs = documents(spark, [*ODD, "aa zz yy xx ww vv uu tt ss bb", "aa zz yy xx ww vv uu tt ss bb"])
    both = {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}
    assert both >= {(len(ODD), 8), (len(ODD) + 1, 8), (10, 7)}
    monkeypatch.setattr(D, "ITEMS_AT_ONCE", 1)
    assert {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()} >= {(len(ODD), 8), (10, 7)}
    assert D.leaks(spark.createDataFrame([], DOC), bench).count() == 0
    assert D.leaks(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert D.contaminated(docs, bench).count() >= 3


def test_latent_vectors_span_the_leading_directions(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(60, 6)) @ rng.normal(size=(6, 40))
    rows = [(list(range(40)), r.tolist()) for r in a]
    v = D.latent_vectors(spark.createDataFrame(rows, "ids array<int>, vals array<float>").repartition(3), 40, rank=6)
    want = np.linalg.svd(a)[2][:6].T
    np.testing.assert_allclose(np.linalg.svd(want.T @ v)[1], np.ones(6), atol=1e-3)


def test_latent_space_takes_all_documents(spark):
    """Two item words share passages only in documents behind the 400 lowest
    hashes, and on both sides of a passage's middle."""
    ids = [r.id for r in spark.range(900).orderBy(F.xxhash64("id", F.lit("lsa"))).collect()]
    items = [(i, [b"%s%d" % (c, k) for k in range(12)]) for i, c in enumerate((b"a", b"b"))]
    texts = {d: ["w"] * 100 for d in ids}
    for n, d in enumerate(ids[400:416]):
        texts[d][20 + n], texts[d][36 + 3 * n] = "a0", "b0"
        texts[d][95 - n] = "a1"
    rows = [(d, " ".join(texts[d]), "en", "s", 1) for d in ids]
    (space,) = D.build_search(spark.createDataFrame(rows, DOC).repartition(5), items).spaces
    words = sorted(w for _, x in items for w in x)
    found = {w: sum(w in t for t in ([x.encode() for x in t] for t in texts.values())) for w in words}
    weight = np.array([np.log(901 / (found[w] + 1)) - np.log(1 / D.COMMON) for w in words])
    passages = [x for _, x in items] + [t[i : i + 64] for t in ([x.encode() for x in t] for t in texts.values()) for i in range(0, 100, 32)]
    a = np.array([[p.count(w) for w in words] for p in passages]) * weight
    a = a[a.any(1)]
    want = np.linalg.svd(a / np.linalg.norm(a, axis=1, keepdims=True))[2]
    got = (space.vectors / weight[:, None]).T
    np.testing.assert_allclose(np.abs((got * want).sum(1))[:3], 1, atol=1e-4)


def test_products_of_sparse_and_full_rows_agree():
    rng = np.random.default_rng(3)
    for size in (7, 4000):
        lengths = rng.integers(1, 6, 50)
        ids = np.concatenate([rng.choice(size, n, False) for n in lengths]).astype(np.int32)
        vals = rng.random(len(ids))
        a = np.zeros((50, size))
        a[np.repeat(np.arange(50), lengths), ids] = vals
        i, j, s = D._products(ids, vals, lengths, size)
        got = np.zeros((size, size))
        got[i, j] = s
        np.testing.assert_allclose(got, np.triu(a.T @ a), atol=1e-9)
        q = rng.normal(size=(size, 5))
        full = a.T @ a
        i, j = np.nonzero(full)
        out = np.zeros((size, 5))
        for at, add in D._times(i, j, full[i, j], q):
            out[at] += add
        np.testing.assert_allclose(out, full @ q, atol=1e-9)


def test_words_of_a_column_are_those_of_its_texts():
    texts = [*(t for t in ODD if t is not None), "a", "b c", "", "d", " e", "f ", "A-b_C\u00c9\x00z"]
    for column in (pa.array(texts), pa.array(texts)[3:-2], pa.array(texts, pa.large_string())[1:2], pa.array(["", " "]), pa.array([], pa.string())):
        words, lengths = D.split_words(column)
        want = [D.words_of(t) for t in column.to_pylist()]
        assert words.to_pylist() == [w for x in want for w in x]
        assert lengths.tolist() == [len(x) for x in want]


def test_texts_are_split_once_for_all_steps(spark, tmp_path):
    """The search runs on the numbers of the words, not on the texts again."""
    item = "zz yy xx ww vv uu tt ss"
    rows = [(None, f"aa {item} bb", "en", "s", 1), (4, f"{item} cc", "en", "s", 1), (4, f"{item} cc", "en", "s", 1), (5, "zz yy xx", "en", "s", 1), (6, None, "en", "s", 1)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents")
    bench = spark.createDataFrame([(8, item), (None, item)], "item_id long, text string")
    found = D.leaks(spark.read.parquet(f"{tmp_path}/documents"), bench)
    assert found.inputFiles() and not any(f"{tmp_path}/documents" in f for f in found.inputFiles())
    got = [(r.doc_id, r.item_id) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(d, i) for d in (None, 4, 4) for i in (8, None)], key=str)


def test_bound_before_the_subsequence_drops_no_leak():
    rng = random.Random(12)
    dropped = 0
    for _ in range(400):
        item = [rng.randrange(25) for _ in range(rng.randint(1, 30))]
        region = [rng.choice(item) if rng.random() < 0.4 else rng.randrange(-1, 25) for _ in range(rng.randint(0, 90))]
        sought = D.Sought(item)
        held = np.array([sought.words.index(w) + 1 if w in sought.words else 0 for w in region], np.int64)
        share = sum(min(region.count(w), item.count(w)) for w in set(item))
        assert sought.may_be_in(held) == (share >= D.least_of(len(item)))
        if not sought.may_be_in(held):
            dropped += 1
            assert brute_verify(item, region) is None
    assert dropped > 20


def test_subsequences_are_sought_only_where_enough_words_are(spark, monkeypatch):
    rng = random.Random(3)
    item = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(40)]
    texts = [" ".join([*rng.sample(item, 12), *(["w"] * 60)]) for _ in range(200)] + [" ".join(item)]
    bench = [(1, [w.encode() for w in item])]
    search = D.build_search(documents(spark, texts), bench)
    calls, lcs = [], D.lcs_length
    monkeypatch.setattr(D, "lcs_length", lambda m, words: calls.append(1) or lcs(m, words))
    got = D.find_leaks(search, *D._numbers(pa.array(texts), search.terms))
    assert [(d, i) for d, i, *_ in got] == [(200, 0)]
    assert len(calls) < 20


def test_windows_against_every_passage_and_part():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(40, 6)).astype(np.float32)
    parts = rng.normal(size=(300, 6)).astype(np.float32)
    norms = np.sort(rng.uniform(0.5, 12, 300).astype(np.float32))
    parts /= np.linalg.norm(parts, axis=1, keepdims=True)
    space = D.Space(np.append(np.arange(40), [-1] * 20), vectors, parts, norms, np.arange(300))
    lengths = np.array([0, 5, 400, 64, 0, 1000, 1])
    terms = np.where(rng.random(lengths.sum()) < 0.2, rng.integers(0, 60, lengths.sum()), -1)
    got = {c[:3] for c in D._windows(space, terms, lengths)}
    want, ends = set(), np.cumsum(lengths)
    for d, n in enumerate(lengths):
        ids = np.append(space.number, -1)[terms[ends[d] - n : ends[d]]]
        for start in range(0, n, 16):
            for size in (32, 64):
                some = ids[start : start + size]
                v = vectors[some[some >= 0]].sum(0)
                dot = parts @ v
                ok = (dot >= D.COSINE * np.linalg.norm(v) * (1 + 1e-5)) & (dot >= D.COVER * norms * (1 + 1e-5)) & (np.linalg.norm(v) > 0)
                want |= {(d, start, int(i)) for i in np.flatnonzero(ok)}
    assert len(want) > 500 and want <= got
    assert len(got) <= 1.01 * len(want)
