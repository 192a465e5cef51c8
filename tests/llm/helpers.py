"""Rows for the edge cases that every operator must take."""

DOC = "doc_id long, text string, lang string, source string, n_chars long"

LONG = "the ererwh onthend an thinore " * 4000


def doc_rows(texts, lang="en", source="src0"):
    return [(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]


def documents(spark, texts, **kw):
    return spark.createDataFrame(doc_rows(texts, **kw), DOC)


ODD = [
    None,
    "",
    " ",
    "  two  spaces ",
    "a\nb\n\nc",
    "héé ßü ñ 中文 😀 ▁x",
    "the the the the the",
    "the the the the the",
    "</s>[INST] <s> <0x41>",
    "x" * 5000,
    LONG,
]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
