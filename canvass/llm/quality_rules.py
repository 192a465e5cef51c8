"""Quality rules with thresholds that adapt to language and source.

Fixed floors come first: at least ``LEAST_WORDS`` words, and at most
``MOST_REPEATED`` per cent of the words in repeated five-word windows. All
further limits come from the data. Four rates of a document, as integers
(mean word length in hundredths, symbols per 10,000 word characters, repeated
lines per 10,000, repeated words per 10,000), go into a quantile sketch of its
language and source: a histogram whose buckets hold integers that agree in
their ``BITS`` leading bits, so a quantile is within one part in 2**(BITS-1)
and sketches merge by adding counts, in any order and exactly. The sketch is
a table (one row a bucket), built by one aggregate with a partial step.

A limit stands ``REACH`` times the distance from the median to the outer
quantile (5 or 95 per cent, at least ``LEAST_SPREAD`` of the rate) beyond that
quantile: at most five per cent of a group can lie outside, and in an
ordinary group next to none. A group of under ``LEAST_DOCS`` documents takes
the limits of its language's merged sketch, a language of as few those of all
documents. Documents meet the limits of their group in a join that spreads
hot groups.

Edge cases: null texts have no words, and documents without words fail the
floors and are in no sketch; null languages and sources are values of their
own; repeated rows count each; ties have no effect (a limit itself is still
kept); an empty table gives no rows; other columns are ignored, whatever
their names. Texts are read whole; memory per text is about 70 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canvass.llm.common import materialise
from canvass.operators import join_dimension

LEAST_WORDS, MOST_REPEATED = 10, 20
BITS = 7
LEAST_DOCS = 100
REACH = 3
# rate -> least distance between median and outer quantile
LEAST_SPREAD = {"word_length": 50, "symbol_rate": 200, "line_rate": 500, "repeat_rate": 200}
LOWER = ("word_length",)  # rates with a lower limit as well
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list[bytes], k: int = WINDOW) -> int:
    """Words that lie in a ``k``-word window found twice or more, exactly:
    windows get numbers by joining the numbers of shorter ones."""
    n = len(words)
    if n <= k:
        return 0
    seen: dict[bytes, int] = {}
    one = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    same, size = one, 1
    while size < k:
        grow = min(size, k - size)
        ahead = same if grow == size else one  # k = 5: windows of 1, 2, 4, 4 + 1
        grow = grow if ahead is same else 1
        m = n - size - grow + 1
        joined = same[:m] * (int(ahead.max()) + 1) + ahead[size : size + m]
        _, same, times = np.unique(joined, return_inverse=True, return_counts=True)
        size += grow
    start = np.flatnonzero(times[same] > 1)
    turn = np.zeros(n + 1, np.int64)
    np.add.at(turn, start, 1)
    np.add.at(turn, start + k, -1)
    return int(np.count_nonzero(np.cumsum(turn[:-1])))


def measure(text: str) -> tuple[int, ...]:
    """``MEASURES`` of a text. Words are runs of other bytes than white space
    of ASCII, which is what ``bytes.split`` gives."""
    raw = text.encode()
    words = raw.split()
    n_lines = n_dup = 0
    seen = set()
    for line in raw.split(b"\n"):
        if not line or line.isspace():
            continue
        n_lines += 1
        n_dup += line in seen
        seen.add(line)
    gaps = len(raw) - sum(map(len, words))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), len(text) - gaps, n_symbols, n_dup, repeated_words(words), n_lines


def measures(text: Column) -> Column:
    """Struct of ``MEASURES`` of a text column (null: the empty text)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([measure(t) for t in s], columns=list(MEASURES), dtype="int64")

    return F.pandas_udf(run, ", ".join(f"{c} long" for c in MEASURES))(F.coalesce(text, F.lit("")))


def _share(n: str, of: str, scale: int) -> Column:
    return F.when(F.col(of) > 0, F.expr(f"({scale} * {n}) div {of}")).otherwise(F.lit(0))


RATES = {
    "word_length": ("word_chars", "n_words", 100),
    "symbol_rate": ("n_symbols", "word_chars", 10_000),
    "line_rate": ("n_dup_lines", "n_lines", 10_000),
    "repeat_rate": ("n_repeat_words", "n_words", 10_000),
}


def bucket(v: Column) -> Column:
    """The least integer that shares the leading ``BITS`` bits of ``v``."""
    drop = F.greatest(F.length(F.bin(v)) - F.lit(BITS), F.lit(0))
    unit = F.pow(F.lit(2.0), drop).cast("long")
    return v - F.pmod(v, unit)


def sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``*keys, rate, bucket, n``: the sketches of the rates of ``rows``."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), bucket(F.col(r)).alias("bucket")) for r in RATES]))
    return rows.select(*keys, each.alias("r")).groupBy(*keys, "r.rate", "r.bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches added up over everything but ``keys``."""
    return sketches.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))


def limits(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """``*keys, rate, docs, low, high`` of every sketch. A sketch has at most
    about 2**(BITS-1) buckets for each doubling of a rate, whatever the rows."""
    w = Window.partitionBy(*keys, "rate")
    upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = sketches.withColumn("upto", F.sum("n").over(upto)).withColumn("docs", F.sum("n").over(w))

    def quantile(q: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("docs") * q, F.col("bucket")))

    q = s.groupBy(*keys, "rate").agg(F.max("docs").alias("docs"), *[quantile(p).alias(f"q{p}") for p in (5, 50, 95)])
    spread = F.lit(0)
    for rate, least in LEAST_SPREAD.items():
        spread = F.when(F.col("rate") == rate, F.lit(least)).otherwise(spread)
    below, over = (F.greatest(d, spread) for d in (F.col("q50") - F.col("q5"), F.col("q95") - F.col("q50")))
    return q.select(
        *keys,
        "rate",
        "docs",
        F.when(F.col("rate").isin(*LOWER), F.col("q5") - REACH * below).alias("low"),
        (F.col("q95") + REACH * over).alias("high"),
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """One row per language and source: ``lang, source, docs`` and for every
    rate ``low_<rate>`` (null where there is none) and ``high_<rate>``."""
    own = sketch(rows, ["lang", "source"])
    by_lang = merged(own, ["lang"])
    levels = limits(own, ["lang", "source"])
    lang = limits(by_lang, ["lang"]).select(
        F.col("lang").alias("l_lang"), F.col("rate").alias("l_rate"), *[F.col(c).alias(f"l_{c}") for c in ("docs", "low", "high")]
    )
    every = limits(merged(by_lang, []), []).select(F.col("rate").alias("a_rate"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    joined = levels.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rate") == F.col("l_rate")))
    joined = joined.join(every, F.col("rate") == F.col("a_rate"))

    def taken(c: str) -> Column:
        of_lang = F.when(F.col("l_docs") >= LEAST_DOCS, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
        return F.when(F.col("docs") >= LEAST_DOCS, F.col(c)).otherwise(of_lang)

    one = joined.select("lang", "source", "docs", "rate", taken("low").alias("low"), taken("high").alias("high"))
    wide = [F.max(F.when(F.col("rate") == r, F.col(c))).alias(f"{c}_{r}") for r in RATES for c in ("low", "high")]
    return one.groupBy("lang", "source").agg(F.max("docs").alias("docs"), *wide)


def judge_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept`` of every row, then ``lang, source``, the four rates
    and ``failed``, the names of the limits that it does not meet."""
    found = docs.select("doc_id", "lang", "source", measures(F.col("text")).alias("m")).select("doc_id", "lang", "source", "m.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    rows = found.select("*", *[_share(*of).alias(r) for r, of in RATES.items()], failed.alias("base_failed"))
    rows = materialise(rows.withColumn("group", F.to_json(F.struct("lang", "source"))), "rule-measures")
    at = thresholds(rows.where(F.col("n_words") > 0))
    at = at.withColumn("of_group", F.to_json(F.struct("lang", "source"))).drop("lang", "source", "docs")
    met = join_dimension(rows, materialise(at, "rule-limits"), "group", "of_group")
    beyond = [F.when(F.col(r) > F.col(f"high_{r}"), F.lit(f"high {r}")) for r in RATES]
    beyond += [F.when(F.col(r) < F.col(f"low_{r}"), F.lit(f"low {r}")) for r in LOWER]
    met = met.withColumn("failed", F.array_compact(F.array(*beyond)))
    kept = ~F.col("base_failed") & (F.size("failed") == 0)
    return met.select("doc_id", *MEASURES[:5], "base_failed", kept.alias("kept"), "lang", "source", *RATES, "failed")


ORACLE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)
),
windows AS (
  SELECT r, i, CASE WHEN lead(i, 4) OVER o IS NOT NULL THEN
    [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] END AS five
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
),
twice AS (SELECT r, i, five IS NOT NULL AND count(*) OVER (PARTITION BY r, five) > 1 AS again FROM windows),
covered AS (
  SELECT r, max(again::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM twice
),
repeats AS (SELECT r, sum(hit)::BIGINT AS n_repeat_words FROM covered GROUP BY r),
word_sums AS (SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM words GROUP BY r),
lines AS (
  SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
line_sums AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
measures AS (
  SELECT r, doc_id, lang, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM docs LEFT JOIN word_sums USING (r) LEFT JOIN line_sums USING (r) LEFT JOIN repeats USING (r)
),
rates AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN (100 * word_chars) // n_words ELSE 0 END AS word_length,
    CASE WHEN word_chars > 0 THEN (10000 * n_symbols) // word_chars ELSE 0 END AS symbol_rate,
    CASE WHEN n_lines > 0 THEN (10000 * n_dup_lines) // n_lines ELSE 0 END AS line_rate,
    CASE WHEN n_words > 0 THEN (10000 * n_repeat_words) // n_words ELSE 0 END AS repeat_rate
  FROM measures
),
each AS (
  SELECT r, lang, source, n_words, rate, value, value // (1 << s) * (1 << s) AS bucket
  FROM (SELECT *, greatest(length(bin(value)) - 7, 0)::INT AS s FROM (
    SELECT r, lang, source, n_words, unnest(['word_length', 'symbol_rate', 'line_rate', 'repeat_rate']) AS rate,
           unnest([word_length, symbol_rate, line_rate, repeat_rate]) AS value FROM rates))
),
sketch AS (SELECT 1 AS level, lang, source, rate, bucket, count(*) AS n FROM each WHERE n_words > 0 GROUP BY ALL
  UNION ALL SELECT 2, lang, NULL, rate, bucket, count(*) FROM each WHERE n_words > 0 GROUP BY ALL
  UNION ALL SELECT 3, NULL, NULL, rate, bucket, count(*) FROM each WHERE n_words > 0 GROUP BY ALL),
summed AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS upto,
                  sum(n) OVER (PARTITION BY level, lang, source, rate) AS docs FROM sketch),
quantiles AS (
  SELECT level, lang, source, rate, max(docs) AS docs, min(bucket) FILTER (upto * 100 >= docs * 5) AS q5,
         min(bucket) FILTER (upto * 100 >= docs * 50) AS q50, min(bucket) FILTER (upto * 100 >= docs * 95) AS q95,
         CASE rate WHEN 'word_length' THEN 50 WHEN 'line_rate' THEN 500 ELSE 200 END AS least
  FROM summed GROUP BY level, lang, source, rate
),
limits AS (
  SELECT *, CASE WHEN rate = 'word_length' THEN q5 - 3 * greatest(q50 - q5, least) END AS low, q95 + 3 * greatest(q95 - q50, least) AS high
  FROM quantiles
),
verdicts AS (
  SELECT e.r, bool_and(e.value <= CASE WHEN o.docs >= 100 THEN o.high WHEN l.docs >= 100 THEN l.high ELSE a.high END
    AND coalesce(e.value >= CASE WHEN o.docs >= 100 THEN o.low WHEN l.docs >= 100 THEN l.low ELSE a.low END, true)) AS inside
  FROM each e
  JOIN limits o ON o.level = 1 AND o.rate = e.rate AND o.lang IS NOT DISTINCT FROM e.lang AND o.source IS NOT DISTINCT FROM e.source
  JOIN limits l ON l.level = 2 AND l.rate = e.rate AND l.lang IS NOT DISTINCT FROM e.lang
  JOIN limits a ON a.level = 3 AND a.rate = e.rate
  GROUP BY e.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, false) AS kept
FROM rates LEFT JOIN verdicts USING (r)
"""
