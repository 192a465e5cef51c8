"""Ranked lexical search of a stated query set over all documents.

Terms are runs of ASCII letters and digits and of all other non-ASCII
characters, A-Z lower-cased. One pass over the texts writes the postings of
the queries' terms: per document the distinct query terms it holds, how often
each, and its length. Corpus counts (documents with a term, all terms, and
documents holding each query term) are sums over all rows.

The postings are searched term at a time, a part of the documents in each
task. Per query the terms come rarest first, and every document met gets an
accumulator with its partial score. Before each term the bounds of it and all
later ones (their highest contribution in the part) are added up: once they
stay below the ``k``-th highest partial score, a document without an
accumulator can no longer reach the first ``k``, so none is created any more
(equal bounds still create: a tie may win by its id). Accumulators there are
go on being updated by every later term, exactly, so the scores and ranks are
those of a full evaluation. A part passes on its ``k`` best per query, which
are cut to ``k`` again over groups of parts before the last cut.

Queries are dealt by hash into blocks of about ``BLOCK_TERMS`` terms, and one
block at a time goes to the tasks, so what they hold does not grow with the
number of queries. All numbers but the logarithm are integers.

Edge cases: null texts have no terms, and count for nothing; a query without
terms, or whose terms are in no document, has no rows; rows that repeat a
query id are one query with all their terms, null ids likewise; a repeated
term of a query counts once; every document row is a document, repeated or
null ids too (equal scores stand by ascending id, nulls last, and rows equal
in both in any order); empty tables give no rows; other columns are ignored,
whatever their names. Texts are read whole; a text takes about 60 bytes a
word while it is counted.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canvass.llm.common import materialise

TOP = 50
BLOCK_TERMS = 1 << 19
PART_POSTINGS = 4 << 20
GROUPS = 32
SATURATION, SLOPE = 1_000_000_000, 1000  # contribution w * (SATURATION * tf div (SLOPE * tf + 20 * m))

_TERMS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Bytes of characters beyond ASCII are never those of a separator."""
    return (text or "").encode().translate(_TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, total: int) -> int:
    return 100 - 50 + (50 * n * n_docs) // total


class Queries:
    """A block of queries: the number of each of their terms, and per query
    its term numbers."""

    def __init__(self, rows: list[tuple[int | None, list[bytes]]]):
        self.ids = [i for i, _ in rows]
        self.number: dict[bytes, int] = {}
        self.of = [[self.number.setdefault(t, len(self.number)) for t in own] for _, own in rows]


def query_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``: the distinct terms of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sorted(set(terms(text)))
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(own), pa.int64()), pa.array(own, pa.binary())], names=["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(run, "item_id long, term binary").distinct()


def postings(docs: DataFrame, q: Queries) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term: its length in
    terms, the numbers of the query terms in it and their occurrences."""
    number = q.number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, found, times, ends = [], [], [], [], [0]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                all_terms = terms(text)
                if not all_terms:
                    continue
                counts = Counter(all_terms)
                own = [(number[t], c) for t, c in counts.items() if t in number]
                found.extend(t for t, _ in own)
                times.extend(c for _, c in own)
                ids.append(i)
                lengths.append(len(all_terms))
                ends.append(len(found))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(times, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Part:
    """Postings of some documents, by term: rows and occurrences."""

    def __init__(self, ids: pa.Array, n: np.ndarray, counts: np.ndarray, found: np.ndarray, times: np.ndarray, n_docs: int, total: int):
        known, place = np.unique(n, return_inverse=True)
        self.ids = ids
        self.m = np.array([length_norm(int(x), n_docs, total) for x in known], np.int64)[place]
        null = ids.is_null().to_numpy(zero_copy_only=False)
        self.tie = np.lexsort((ids.fill_null(0).to_numpy(), null)).argsort()
        order = np.argsort(found, kind="stable")
        self.rows = np.repeat(np.arange(len(n)), counts)[order]
        self.times = times[order].astype(np.int64)
        names, first = np.unique(found[order], return_index=True)
        self.range = dict(zip(names.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(order)])))

    def contributions(self, term: int, w: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.range.get(term, (0, 0))
        rows, tf = self.rows[lo:hi], self.times[lo:hi]
        return rows, w * ((SATURATION * tf) // (SLOPE * tf + 20 * self.m[rows]))

    def best(self, query: list[tuple[int, int]], k: int, score: np.ndarray, open_rows: np.ndarray) -> tuple[np.ndarray, int]:
        """Rows of the ``k`` best documents of a query ((term, weight), the
        rarest first) and how many accumulators it took. ``score`` and
        ``open_rows`` are zeros, and are left so."""
        lists = [self.contributions(t, w) for t, w in query]
        bounds = np.cumsum([0, *[int(c.max()) if len(c) else 0 for _, c in lists]][::-1])[::-1]
        active = np.empty(0, np.int64)
        create = True
        for (rows, points), bound in zip(lists, bounds.tolist()):
            if create and len(active) >= k:
                create = bound >= np.partition(score[active], len(active) - k)[len(active) - k]
            if create:
                new = rows[~open_rows[rows] & (points > 0)]
                open_rows[new] = True
                active = np.concatenate([active, new])
            held = open_rows[rows]
            score[rows[held]] += points[held]
        kept = active
        if len(kept) > k:
            kth = np.partition(score[kept], len(kept) - k)[len(kept) - k]
            kept = kept[score[kept] >= kth]
        kept = kept[np.lexsort((self.tie[kept], -score[kept]))][:k]
        result = kept, score[kept].copy()
        self.accumulators = len(active)
        score[active] = 0
        open_rows[active] = False
        return result


def search_part(part: Part, q: Queries, weights: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    score, open_rows = np.zeros(len(part.m), np.int64), np.zeros(len(part.m), bool)
    items, ids, scores = [], [], []
    for i, own in zip(q.ids, q.of):
        query = sorted(((t, int(weights[t])) for t in own if weights[t] > 0), key=lambda x: (-x[1], x[0]))
        rows, points = part.best(query, k, score, open_rows)
        items.extend([i] * len(rows))
        ids.append(part.ids.take(pa.array(rows)))
        scores.append(points)
    yield pa.RecordBatch.from_arrays(
        [pa.array(items, pa.int64()), pa.concat_arrays([pa.array([], pa.int64()), *ids]), pa.array(np.concatenate([np.empty(0, np.int64), *scores]))],
        names=["item_id", "doc_id", "score"],
    )


def _search_block(docs: DataFrame, q: Queries, k: int) -> DataFrame:
    """``item_id, doc_id, score``: the k best of every part, per query."""
    spark = docs.sparkSession
    rows = materialise(postings(docs, q), "postings")
    n_docs, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one row per query term at most
    df = dict(tuple(r) for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect())
    weights = np.array([weight(n_docs, df[t]) if t in df else 0 for t in range(len(q.number))], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0

        def parts() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(waiting).combine_chunks()
            if not t.num_rows:
                return
            found, times = (t[c].chunk(0) for c in ("terms", "tfs"))
            counts = pa.compute.list_value_length(found).to_numpy()
            part = Part(t["doc_id"].chunk(0), t["n"].to_numpy(), counts, found.flatten().to_numpy(), times.flatten().to_numpy(), n_docs, total)
            yield from search_part(part, q, weights, k)

        for batch in batches:
            waiting.append(batch)
            size += batch.column("terms").flatten().__len__() + batch.num_rows
            if size >= PART_POSTINGS:
                yield from parts()
                waiting, size = [], 0
        if waiting:
            yield from parts()

    best = rows.mapInArrow(run, "item_id long, doc_id long, score long")
    return materialise(best, "part-best")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents
    of every query, from rank 1."""
    wanted = materialise(query_terms(items), "query-terms")
    blocks = -(-wanted.count() // block_terms)
    found = None
    for b in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        rows: dict[int | None, list[bytes]] = {}
        for i, t in own.toLocalIterator():
            rows.setdefault(i, []).append(bytes(t))
        q = Queries([(i, sorted(rows[i])) for i in sorted(rows, key=lambda x: (x is None, x or 0))])
        best = _search_block(docs, q, k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    group = F.pmod(F.xxhash64("doc_id", "score"), F.lit(GROUPS))
    first = Window.partitionBy("item_id", "_group").orderBy(*order)
    cut = found.withColumn("_group", group).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    last = Window.partitionBy("item_id").orderBy(*order)
    return cut.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = r"""
WITH words AS (
  SELECT rowid_ AS r, doc_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)
),
wanted AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
),
lengths AS (SELECT r, any_value(doc_id) AS doc_id, count(*)::HUGEINT AS n FROM words GROUP BY r),
corpus AS (SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS total FROM lengths),
tf AS (SELECT r, term, count(*)::HUGEINT AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::HUGEINT AS w FROM df, corpus),
scored AS (
  SELECT item_id, r, any_value(l.doc_id) AS doc_id,
         sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (100 - 50 + (50 * l.n * c.docs) // c.total)))) AS score
  FROM wanted JOIN tf USING (term) JOIN w USING (term) JOIN lengths l USING (r), corpus c
  GROUP BY item_id, r
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 50
"""
