"""Documents to training tokens, in five stages.

Every stage takes the rows its predecessor kept and is written as Parquet in
between. Language identification drops what it rejects, SimHash keeps one
document of each group of near copies, decontamination drops documents that
hold a benchmark item, personal data is masked in place, and SentencePiece
turns each text into ids and checks that they decode to it.

Null texts have no letters, so the first stage drops them; null and repeated
ids, empty tables and further columns pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm import decontaminate, language_id, pii, sentencepiece_bpe, simhash
from canvass.llm.common import bound_batches, materialise, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; a null ``lang`` is filled in."""
    bound_batches(spark)
    # the other columns stand aside under names that no operator uses
    names = [c if c in ("doc_id", "text", "lang") else f"column {i}" for i, c in enumerate(docs.columns)]
    found = language_id.identify(docs.toDF(*names)).where(~F.col("language.rejected"))
    lang = F.coalesce("lang", "language.lang_pred")
    return found.select(*((lang if n == "lang" else F.col(n)).alias(c) for n, c in zip(names, docs.columns)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return simhash.keep_one_of_each(docs, shingle=4, radius=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All spans masked; ``n_chars`` is the length of the masked text."""
    bound_batches(spark)
    out = docs.withColumn("text", pii.masked(F.col("text"), pii.train(docs)))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    rows = docs.select("doc_id", "lang", "source", "text")
    return sentencepiece_bpe.encode_checked(rows).select("doc_id", "lang", "source", "encoding.*")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("PII", mask_personal_data),
    ("SentencePiece encoding and decoding", encode_tokens),
]

# Models fitted to the rows (language, personal data) and a tokenizer file
# are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{i + 1}")
    return docs
