import duckdb  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline as C
from canvass.llm import decontaminate, language_id, simhash
from canvass.llm.catalog import QUERIES
from tests.llm.helpers import DOC, ODD, by_id
from tests.llm.test_pii import brute_base
from tests.llm.test_sentencepiece import library
from tests.llm.test_simhash import brute_components, brute_fingerprint

TESTDATA = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    stages = dict(C.STAGES)
    seen, cols = docs, docs.columns
    kept = []
    for i, (name, stage) in enumerate(C.STAGES):
        stage(spark, seen, TESTDATA).write.parquet(f"{tmp_path}/{i}")
        seen = spark.read.parquet(f"{tmp_path}/{i}")
        assert i == 4 or seen.columns == cols
        kept.append(by_id(seen))
    rejected = {r.doc_id for r in language_id.predict_languages(docs).where("rejected").collect()}
    assert set(kept[0]) == {r.doc_id for r in docs.collect()} - rejected and len(rejected) <= 3
    comp = brute_components({i: brute_fingerprint(r.text) for i, r in kept[0].items()})
    assert set(kept[1]) == set(comp.values())
    leaked = {i for i, r in kept[1].items() if any(x in r.text for x in items)}
    assert leaked and set(kept[2]) <= set(kept[1]) - leaked
    extra = set(kept[1]) - leaked - set(kept[2])
    for i in extra:
        words = decontaminate.words_of(kept[1][i].text)
        assert any(decontaminate.verify(decontaminate.words_of(x), words) or decontaminate.lcs_length(decontaminate.masks(decontaminate.words_of(x)), words) >= 0.6 * len(x.split()) for x in items)
    assert set(kept[3]) == set(kept[2])
    for i, r in kept[3].items():
        before = kept[2][i].text
        if brute_base(before):
            assert not brute_base(r.text) and r.text != before
        assert r.n_chars == len(r.text)
    for i, r in kept[4].items():
        assert list(r.token_ids) == library(kept[3][i].text) and r.n_tokens == len(r.token_ids) and r.round_trip
    assert stages and C.run(spark, TESTDATA).count() == len(kept[4])


def test_stages_take_odd_rows(spark):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(ODD)]
    rows += [(100 + i, "the then there thin that this other and more of it", None, None, None) for i in range(3)]
    rows += [(None, "the then there thin that this other and more of it", None, None, None)] * 2 + [(200, "in inner to inn ten tin", "en", "s", 3)] * 3
    docs = spark.createDataFrame(rows, DOC).withColumn("root", F.lit("clash")).withColumn("language", F.lit(1))
    for c in ("_lang", "row", "_p", "_fp", "_id", "fp", "id", "print", "score"):
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    for i, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, TESTDATA).collect()
        assert len(out) <= len(rows)
        for r in out if i < 4 else []:
            assert r["language"] == 1 and r["root"] == "clash" and r["_fp"] == "own _fp" and r["row"] == "own row" and r["score"] == "own score"
        assert stage(spark, docs.limit(0), TESTDATA).count() == 0
    one = simhash.keep_one_of_each(docs).collect()
    assert len([r for r in one if r.doc_id == 200]) == 1 and not [r for r in one if r.doc_id is None]
    assert len([r for r in one if r.doc_id in (100, 101, 102)]) == 1
    nulls = docs.where("doc_id is null")
    assert simhash.keep_one_of_each(nulls).count() == 1


def test_every_operator_has_one_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14))
