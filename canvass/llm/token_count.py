"""Token counts of whole texts with a public tokenizer file.

The counting function is an Arrow-batched function that returns lengths
only; token ids never leave the Python worker. Inside a batch, texts are
regrouped into library calls of about ``CALL_BYTES`` of UTF-8, so that a
call's memory does not depend on how rows fell into Arrow batches, and a
text above ``SPLIT_CHARS`` is cut at safe boundaries: before a single space
or a single line end between two other characters. The encoder puts a word
mark before every piece it encodes, no vocabulary entry has a word mark after
another character, and none but the line end itself holds one. So dropping a
space there and counting both sides apart gives the same tokens, and before a
line end the part behind it has one token more, the mark, which is taken off
again (``safe_to_split`` checks the model for this; a model that fails the
check is encoded whole).

Edge cases: null counts as the empty text, which has 0 tokens; a text
without a safe boundary is encoded whole, at about 50 bytes a byte; repeated
rows and rows of one id count each; ties cannot occur; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canvass.llm.common import by_bytes, utf8_length

CALL_BYTES = 1 << 19
SPLIT_CHARS = 1 << 15
MARK = "▁"
_CUT = re.compile(rf"(?<=[^\s{MARK}])(?: (?=[^\s{MARK}])|(?=\n[^\s{MARK}]))")
DEFAULT_MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on the machine that runs the task; a
    name with a slash is a path already."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(model))


@lru_cache(maxsize=4)
def safe_to_split(model: str) -> bool:
    """The model marks words with a leading word mark, keeps white space as
    it is, adds one mark at the start, and no entry but a run of marks has a
    mark after its first character."""
    sp = processor(model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(MARK in p[1:] and p.strip(MARK) for p in pieces) or any("\n" in p and len(p) > 1 for p in pieces):
        return False
    if sp.encode("a\nb") != sp.encode("a") + sp.encode("\nb")[1:]:
        return False
    return sp.encode("ab ab") == sp.encode("ab") * 2 and len(sp.encode("  a", out_type=str)) > 1 and sp.encode("a ") != sp.encode("a")


def split_safely(text: str, limit: int = SPLIT_CHARS) -> list[str]:
    """Parts of ``text`` whose token counts add up to its own, less one for
    every part after the first that starts with a line end."""
    parts: list[str] = []
    start = 0
    while len(text) - start > limit and (m := _CUT.search(text, start + limit)):
        parts.append(text[start : m.start()])
        start = m.end()
    parts.append(text[start:])
    return parts


def count_tokens(texts: list[str], model: str = DEFAULT_MODEL) -> list[int]:
    sp, split = processor(model), safe_to_split(model)
    pieces: list[str] = []
    owner: list[int] = []
    counts = [0] * len(texts)
    for i, t in enumerate(texts):
        parts = split_safely(t) if split and len(t) > SPLIT_CHARS else [t]
        pieces += parts
        owner += [i] * len(parts)
        counts[i] -= sum(p.startswith("\n") for p in parts[1:])
    at = 0
    for call in by_bytes(pieces, CALL_BYTES, utf8_length):
        for ids in sp.encode(call, num_threads=1):
            counts[owner[at]] += len(ids)
            at += 1
    return counts


def token_count(text: Column, model: str = DEFAULT_MODEL) -> Column:
    """Number of tokens of a text column, without begin or end ids."""

    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(count_tokens([t if isinstance(t, str) else "" for t in s], model), dtype="int64")

    return F.pandas_udf(lengths, T.LongType())(F.coalesce(text, F.lit("")))


def count_documents(docs: DataFrame, limit: int = 4096, model: str = DEFAULT_MODEL) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), token_count(F.col("text"), model).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
