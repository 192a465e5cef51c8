import hashlib
import random

import pytest
from pyspark.sql import functions as F

from canvass.llm import sentencepiece_bpe as B
from canvass.llm import token_count as T
from canvass.llm.catalog import QUERIES
from canvass.llm.common import by_bytes, utf8_length
from tests.llm.helpers import DOC, ODD, by_id, documents

TESTDATA = "/root/testdata/sf0.001"


def library(t):
    return T.processor(T.DEFAULT_MODEL).encode(t or "")


def test_encoder_equals_library_on_random_strings():
    rng = random.Random(5)
    alphabet = [*"aabcdehiorst  \n\t▁<>/0x12.,éß中😀\x00ा'", "the", "ing", "tion", "<s>", "    ", "\n\n", "<0x41>"]
    enc = B.encoder()
    for _ in range(4000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))
        assert enc.encode(s) == library(s), s
        assert enc.decode(enc.encode(s)) == T.processor(T.DEFAULT_MODEL).decode(library(s))
    for n in range(70):
        for s in (" " * n, " " * n + "the", "a" + " " * n, "\n" * n, "ab" * n, "é" * n):
            assert enc.encode(s) == library(s), s


def test_prefix_table_holds_the_last_token_of_each_prefix():
    enc = B.encoder()
    word = "▁interestingly"
    for n in range(1, len(word) + 1):
        assert enc.tokens(word[:n]) == enc.merge(word[:n])


def test_digests_and_counts_on_odd_texts(spark):
    docs = documents(spark, ODD).withColumn("n_tokens", F.lit("clash")).withColumn("d", F.lit(1))
    got, counts = by_id(B.digests(docs)), by_id(T.count_documents(docs))
    sp = T.processor(T.DEFAULT_MODEL)
    for i, t in enumerate(ODD):
        ids = library(t)
        assert got[i].n_tokens == counts[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        assert counts[i].n_bytes == len((t or "").encode())
        assert counts[i].over_limit == (len(ids) > 4096)


def test_round_trip_columns(spark):
    docs = documents(spark, ODD)
    out = by_id(B.decode_documents(B.encode_documents(docs)))
    for i, t in enumerate(ODD):
        assert list(out[i].token_ids) == library(t)
        assert out[i].decoded == (t or "").replace("▁", " ")


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], DOC)
    assert B.digests(empty).count() == T.count_documents(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b", None, None, None)] * 2, DOC)
    assert B.digests(odd).count() == T.count_documents(odd).count() == 2


def test_split_parts_add_up():
    sp = T.processor(T.DEFAULT_MODEL)
    assert T.safe_to_split(T.DEFAULT_MODEL)
    rng = random.Random(8)
    for _ in range(600):
        s = "".join(rng.choice(["ab", " ", "  ", "\n", "\n\n", "▁", "\t", "é", "中", ".", "<s>", " \n", "12", "x"]) for _ in range(60))
        parts = T.split_safely(s, limit=rng.choice([1, 7, 20]))
        less = sum(p.startswith("\n") for p in parts[1:])
        assert sum(len(sp.encode(p)) for p in parts) - less == len(sp.encode(s)), parts


def test_texts_of_lines_without_spaces_are_cut(monkeypatch):
    text = "one.two\nthree(four)\nfünf,中文\n" * 3000
    assert max(map(len, T.split_safely(text))) < T.SPLIT_CHARS + 50
    assert T.count_tokens([text, "a b"]) == [len(T.processor(T.DEFAULT_MODEL).encode(text)), 2]


def test_calls_are_balanced_by_bytes():
    texts = ["中" * 100] * 10 + ["x" * 100] * 10
    calls = list(by_bytes(texts, 600, utf8_length))
    assert [sum(len(t.encode()) for t in c) for c in calls] == [600] * 6 + [400] and [t for c in calls for t in c] == texts


def test_split_without_a_boundary():
    assert T.split_safely("x" * 100, limit=10) == ["x" * 100]


@pytest.mark.parametrize("name", ["op4_sentencepiece", "op9_token_counts"])
def test_queries_against_library(spark, name):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    got = by_id(QUERIES[name](spark, TESTDATA))
    assert len(got) == len(text)
    for i, t in text.items():
        assert got[i].n_tokens == len(library(t))


def test_memory_of_words_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(B, "WORDS_BYTES", 1 << 18)
    enc = B.PrefixTableEncoder(B.DEFAULT_MODEL)
    rng = random.Random(11)
    for n in [30] * 300 + [3000] * 5 + [5] * 300:
        t = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n))
        assert enc.encode(t) == library(t)
        held = sum(200 + 4 * len(w) + 8 * len(ids) for w, ids in enc.words.items())
        assert held == enc.words_held <= 1 << 18
        assert n < 3000 or all(len(w) < 3000 for w in enc.words)
