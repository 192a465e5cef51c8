"""Benchmark decontamination by latent semantic retrieval.

Benchmark items go to all documents in blocks of bounded size. For a block:

1. Terms are the block's words (runs of ASCII letters, digits and other
   non-ASCII characters; A-Z lower-cased). Document frequencies come from
   all documents. A term's weight is its IDF above that of a term in
   ``COMMON`` of the documents, so common words carry none. Items left with
   under ``LEAST_TERMS`` weighted terms (their words are common, or the item
   itself is all over the corpus) form a second group with plain IDF over
   its own terms, searched apart.
2. A distributed randomised SVD (A'A added up over partitions, subspace
   iteration on it) of the TF-IDF passages of all documents and of all item
   parts gives a latent space of rank ``RANK``. Documents are turned into
   numbers of the block's terms once, which the frequencies, the passages and
   the search come from; the row filter alone reads the texts again.
3. Shared words give every candidate there is. An item that loses at most
   ``spare`` of its words must show ``least`` of its rarest ``spare + least``
   ones (``Shared``); every stretch of a document that does is a candidate,
   whatever the weights, the lengths and the rank of the space.
   Besides, every document is cut into passages of 32 and 64 words that start
   every 16 words. A passage is a candidate for an item part (at most 48 words) if
   the cosine in latent space is at least ``COSINE`` and the passage holds at
   least ``COVER`` of the part's weight along its direction. Passages shorter
   than the second condition allows are skipped beforehand, exactly.
4. Around a candidate, the longest common subsequence with the whole item,
   within any stretch of about one and a half times its length, decides: a share
   of ``LCS`` of the item's words, or ``PARAPHRASE`` together with its answer
   (the last ``ANSWER`` words, three quarters of them in order). Items under
   eight words must be there in full.

Edge cases: null or empty texts and items match nothing; null ids are kept;
repeated documents or items give a row each; empty tables give no rows; other
columns are ignored; texts are read whole, whatever their length.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import hold_alone, materialise

COMMON = 0.02
LEAST_TERMS = 4
RANK, OVERSAMPLE, ROUNDS = 128, 10, 3
BLOCK_WORDS, PART_WORDS = 16, 48
HALF_WORDS = 32  # half a passage of the latent space
ROWS_IN_SUM, CELLS_AT_ONCE, DENSE_AT_ONCE = 1 << 10, 1 << 21, 1 << 22
COSINE, COVER = 0.55, 0.45
LCS, PARAPHRASE, ANSWER = 0.8, 0.6, 4
ITEMS_AT_ONCE, BYTES_AT_ONCE = 2000, 4 << 20
WORDS_AT_ONCE, WINDOWS_AT_ONCE = 1 << 17, 256
PAIRS_AT_ONCE = 1 << 20

_KEEP = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEEP).split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The :func:`words_of` all texts of a column, one after the other, and
    how many each text has."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    data = np.frombuffer(_KEEP, np.uint8)[data]
    inside = data != 32
    cut = np.ones(len(data) + 1, bool)  # no word goes on from the byte before
    cut[1:-1] = ~inside[:-1]
    cut[ends] = True
    first = np.flatnonzero(inside & cut[:-1])
    cut[:-1] |= ~inside
    last = np.flatnonzero(inside & cut[1:])
    offsets = np.append(0, np.cumsum(last + 1 - first))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    return pa.Array.from_buffers(pa.large_binary(), len(first), buffers), np.diff(np.searchsorted(first, ends))


def _numbers(texts: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts among ``terms`` (-1: none), one text
    after the other, and how many words each has."""
    words, lengths = split_words(texts)
    return pc.index_in(words, value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False), lengths


def lcs_length(item: dict, words: list) -> int:
    """Longest common subsequence with an item given as word -> bit mask of
    its places (bit-parallel, one integer)."""
    free = (1 << item[None]) - 1
    full = free
    for w in words:
        if m := item.get(w):
            u = free & m
            free = ((free + u) | (free - u)) & full
    return item[None] - free.bit_count()


def masks(words: list) -> dict:
    out: dict = {None: len(words)}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def least_of(n: int) -> float:
    """The words of an item of ``n`` that have to be there in order."""
    return (PARAPHRASE if n >= 8 else 1.0) * n


def stretch(n: int) -> int:
    """Length of the stretches of text in which an item of ``n`` is sought."""
    return n + n // 2 + 2


class Sought:
    """An item, made ready to be sought in many regions of text."""

    def __init__(self, item: list):
        self.item, self.n, self.least = item, len(item), least_of(len(item))
        count = Counter(item)
        self.words, self.count = list(count), np.array([0, *count.values()])

    @cached_property
    def masks(self) -> tuple[dict, dict]:
        return masks(self.item), masks(self.item[-ANSWER:])

    def may_be_in(self, held: np.ndarray) -> bool:
        """Whether a region holds enough of the item in any order, from the
        place of each of its words in ``words``, from 1 (0: not there)."""
        return np.minimum(np.bincount(held, minlength=len(self.count)), self.count).sum() >= self.least

    def verify(self, region: list) -> tuple[float, bool] | None:
        """(LCS share, answer found) of the best stretch of ``region`` that
        passes, None if none does. Every stretch is looked at: runs of
        neighbouring ones are left out together where all their words hold too
        little of the item, since then each of them does, and one with the
        same words of the item as the stretch before gives the same."""
        n, least = self.n, self.least
        m, end = self.masks
        places = [p for p, w in enumerate(region) if w in m]
        held = [region[p] for p in places]
        if lcs_length(m, held) < least:
            return None
        size, step = stretch(n), max(1, n // 4)
        last = max(0, len(region) - size)
        best = before = None
        for i in range(0, last + 1, step):
            run = range(i, min(i + step, last + 1))
            if lcs_length(m, held[bisect_left(places, i) : bisect_left(places, run[-1] + size)]) < least:
                continue
            for j in run:
                of = slice(bisect_left(places, j), bisect_left(places, j + size))
                if of == before:
                    continue
                before, words = of, held[of]
                k = lcs_length(m, words)
                if k < least:
                    continue
                answer = lcs_length(end, words) >= 0.75 * end[None]
                if k >= LCS * n or answer:
                    best = max(best or (0.0, False), (k / n, answer))
                    if best == (1.0, True):
                        return best
        return best


def verify(item: list, region: list) -> tuple[float, bool] | None:
    return Sought(item).verify(region)


@dataclass
class Space:
    """One group of items: the group's number of each term (-1: none), their
    latent vectors (weight included), and the item parts in latent space,
    shortest first."""

    number: np.ndarray
    vectors: np.ndarray
    parts: np.ndarray
    norms: np.ndarray
    part_item: np.ndarray


@dataclass
class Shared:
    """The rarest words of every item, as many as may be missing from it and
    ``least`` more: term -> number (-1: none) -> its items (a range of
    ``item``), and per item the length of a stretch and the least number of
    these words in one."""

    number: np.ndarray
    first: np.ndarray
    item: np.ndarray
    stretch: np.ndarray
    least: np.ndarray


@dataclass
class Search:
    """A block's items as numbers of its ``terms``, and the ways to them."""

    items: list[tuple[int | None, list[int]]]
    terms: pa.Array
    spaces: list[Space]
    shared: Shared


def _split_item(words: list) -> list[list]:
    k = -(-len(words) // PART_WORDS)
    return [words[len(words) * i // k : len(words) * (i + 1) // k] for i in range(k)]


def _tf(words: list, number: dict, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Unit TF-IDF row as (terms, values), or None without a weighted term."""
    c = Counter(i for w in words if (i := number.get(w)) is not None and weight[i] > 0)
    if not c:
        return None
    ids = np.fromiter(c.keys(), np.int64, len(c))
    v = np.fromiter(c.values(), float, len(c)) * weight[ids]
    return ids, v / np.linalg.norm(v)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after the other, and the lengths."""
    c = batch.column(name)
    lengths = c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return c.flatten().to_numpy(zero_copy_only=False), lengths


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(values))


def _terms(items: list[tuple[int | None, list[bytes]]]) -> dict[bytes, int]:
    return {w: i for i, w in enumerate(sorted({w for _, words in items for w in words}))}


def numbered(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """A row per text: in place of ``text`` its words' numbers among
    ``terms`` (-1: none) as ``term``, in order; other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(pa.array(list(terms), pa.large_binary()))
    others = [c for c in docs.columns if c != "text"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths = _numbers(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([*map(batch.column, others), _lists(ids, lengths)], [*others, "term"])

    texts = docs.where(F.col("text").isNotNull())
    schema = docs.select(*others, F.lit(None).cast("array<int>").alias("term")).schema
    return materialise(texts.mapInArrow(number, schema), "numbered")


def document_frequencies(rows: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Per term the number of documents of :func:`numbered` that hold it, and
    all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        n = 0
        for batch in batches:
            term, lengths = _flat(batch, "term")
            known = term >= 0
            pairs = np.unique(np.repeat(np.arange(len(lengths)) * size, lengths)[known] + term[known])
            held += np.bincount(pairs % size, minlength=size)
            n += len(lengths)
        some = np.flatnonzero(held)
        both = [pa.array(np.append(-1, some), pa.int32()), pa.array(np.append(n, held[some]), pa.int64())]
        yield pa.RecordBatch.from_arrays(both, ["term", "n"])

    got = rows.select("term").mapInArrow(count, "term int, n long")
    got = got.groupBy("term").agg(F.sum("n").alias("n")).toPandas()  # a row per term of the block
    df = np.zeros(size)
    some = got[got["term"] >= 0]
    df[some["term"]] = some["n"]
    return df, int(got.loc[got["term"] < 0, "n"].sum())


def _products(ids: np.ndarray, vals: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells (i, j, sum), i <= j, of A'A of a few sparse rows A."""
    if 16 * len(ids) >= len(lengths) * size:
        a = np.zeros((len(lengths), size))
        a[np.repeat(np.arange(len(lengths)), lengths), ids] = vals
        full = np.triu(a.T @ a)
        i, j = np.nonzero(full)
        return i, j, full[i, j]
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(ids))  # from each value to the end of its row
    one = np.repeat(np.arange(len(ids)), left)
    other = one + np.arange(len(one)) - np.repeat(np.cumsum(left) - left, left)
    x, y = ids[one].astype(np.int64), ids[other]
    keys, at = np.unique(np.minimum(x, y) * size + np.maximum(x, y), return_inverse=True)
    return keys // size, keys % size, np.bincount(at, vals[one].astype(float) * vals[other])


def products(rows: DataFrame, size: int, cut: Callable[[Iterator], Iterator] = iter) -> DataFrame:
    """Cells (i, j, sum), i <= j, to be added up to A'A, where the rows of A
    (ids, vals) are those that ``cut`` makes of the Arrow batches of ``rows``."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            ids, lengths = _flat(batch, "ids")
            vals, _ = _flat(batch, "vals")
            lengths = lengths[lengths > 0]
            ends, pairs = np.cumsum(lengths), np.cumsum(lengths**2)
            a = 0
            while a < len(ends):
                x = int(ends[a] - lengths[a])
                b = max(a + 1, int(np.searchsorted(pairs, pairs[a] - lengths[a] ** 2 + PAIRS_AT_ONCE, "right")))
                i, j, total = _products(ids[x : ends[b - 1]], vals[x : ends[b - 1]], lengths[a:b], size)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total)], ["i", "j", "s"])
                a = b

    return rows.mapInArrow(cells, "i int, j int, s double")


def _times(i: np.ndarray, j: np.ndarray, s: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their sums) of G Q for cells of the matrix G sorted by i."""
    first = np.flatnonzero(np.diff(i, prepend=-1))
    sizes = np.diff(np.append(first, len(i)))
    step = max(1, DENSE_AT_ONCE // len(q))
    for a in range(0, len(first), step):
        n, x = sizes[a : a + step], first[a]
        of = slice(x, x + n.sum())
        rows = i[first[a : a + step]]
        if 64 * n.sum() >= len(n) * len(q):
            g = np.zeros((len(n), len(q)))
            np.add.at(g, (np.repeat(np.arange(len(n)), n), j[of]), s[of])
            yield rows, g @ q
        else:
            yield rows, np.add.reduceat(s[of, None] * q[j[of]], first[a : a + step] - x)


def latent_vectors(passages: DataFrame, size: int, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Right singular vectors (``size`` x rank) of the rows of ``passages``
    (ids array<int>, vals array<float>)."""
    rows = passages.select(F.col("ids").cast("array<int>"), F.col("vals").cast("array<float>"))
    return leading_vectors(products(rows, size), size, rank, seed)


def leading_vectors(cells: DataFrame, size: int, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Leading eigenvectors (``size`` x rank) of the matrix A'A that
    ``cells`` (:func:`products`) add up to, by randomised subspace iteration:
    A'A is added up once, with the cells of a row in one partition, and every
    round sums A'A Q per partition, then by ranges of rows, so the driver
    takes one matrix however many partitions there are."""
    k = min(size, rank + OVERSAMPLE)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, k)))[0]
    sc = cells.sparkSession.sparkContext
    added = cells.groupBy("i", "j").agg(F.sum("s").alias("s"))
    mirrored = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    whole = added.select(F.explode(mirrored).alias("at"), "s").select("at.i", "at.j", "s")
    matrix = materialise(whole.repartition(max(8, sc.defaultParallelism), "i"), "products")
    for r in range(ROUNDS + 1):
        shared = sc.broadcast(q)
        last = r == ROUNDS

        def partial(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            q = shared.value
            out = np.zeros((k if last else size, k))
            batches = iter(batches)
            while some := list(_up_to(batches, CELLS_AT_ONCE)):
                i, j, s = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in some]) for c in range(3))
                order = np.argsort(i, kind="stable")
                for at, add in _times(i[order], j[order], s[order], q):
                    if last:
                        out += q[at].T @ add
                    else:
                        out[at] += add
            part = TaskContext.get().partitionId()
            for first in range(0, len(out), ROWS_IN_SUM):
                m = out[first : first + ROWS_IN_SUM]
                if m.any():
                    fields = [pa.array([first], pa.int32()), pa.array([part], pa.int32()), pa.array([m.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(fields, ["first", "part", "m"])

        def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
            parts = pdf.sort_values("part")["m"]  # in one order, so that a retry adds up to the same
            return pd.DataFrame({"first": pdf["first"][:1], "m": [sum(np.frombuffer(m) for m in parts).tobytes()]})

        sums = matrix.mapInArrow(partial, "first int, part int, m binary").groupBy("first").applyInPandas(add_up, "first int, m binary")
        total = np.zeros((k if last else size, k))
        for row in sums.collect():  # a row per ROWS_IN_SUM terms of the block
            m = np.frombuffer(row["m"]).reshape(-1, k)
            total[row["first"] : row["first"] + len(m)] = m
        if last:
            values, u = np.linalg.eigh(total)
            return q @ u[:, np.argsort(-values)[:rank]]
        q = np.linalg.qr(total)[0]


def _up_to(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches until they hold ``rows`` rows."""
    for batch in batches:
        yield batch
        rows -= len(batch)
        if rows <= 0:
            return


def _cut_passages(number: np.ndarray, weight: np.ndarray) -> Callable[[Iterator], Iterator]:
    """Function of Arrow batches of :func:`numbered`: unit TF-IDF rows (ids,
    vals) of the passages of its documents, two neighbouring runs of words
    each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, lengths = _flat(batch, "term")
            word = np.append(number, -1)[term]
            hit = np.flatnonzero(word >= 0)
            text = np.repeat(np.arange(len(lengths)), lengths)[hit]
            half = (hit - (np.cumsum(lengths) - lengths)[text]) // HALF_WORDS
            size = -(-lengths // HALF_WORDS)
            run = (np.cumsum(size) - size)[text] + half
            word, second = word[hit], half > 0
            keys = np.concatenate((run, run[second] - 1)) * len(weight) + np.concatenate((word, word[second]))
            keys, n = np.unique(keys, return_counts=True)
            if not len(keys):
                continue
            passage, ids = keys // len(weight), (keys % len(weight)).astype(np.int32)
            first = np.flatnonzero(np.diff(passage, prepend=-1))
            sizes = np.diff(np.append(first, len(keys)))
            vals = n * weight[ids]
            vals /= np.repeat(np.sqrt(np.add.reduceat(vals**2, first)), sizes)
            yield pa.RecordBatch.from_arrays([_lists(ids, sizes), _lists(vals, sizes)], ["ids", "vals"])

    return cut


def _space(rows: DataFrame, items: list[tuple[int, list]], weight_of: dict[bytes, float], terms: dict[bytes, int]) -> Space:
    """``rows``: all documents as :func:`numbered` by ``terms``."""
    number = {w: i for i, w in enumerate(sorted(weight_of))}
    weight = np.array([weight_of[w] for w in sorted(weight_of)])
    number_of_term = _renumbered(number, terms)
    parts, owner = [], []
    for i, words in items:
        for p in _split_item(words):
            if (row := _tf(p, number, weight)) is not None:
                parts.append(row)
                owner.append((i, np.linalg.norm([weight_of.get(w, 0.0) * n for w, n in Counter(p).items()])))
    own = rows.sparkSession.createDataFrame([(r[0].tolist(), r[1].tolist()) for r in parts], "ids array<int>, vals array<double>")
    cells = products(own, len(number)).unionByName(products(rows, len(number), _cut_passages(number_of_term, weight)))
    v = leading_vectors(cells, len(number))
    vectors = (v * weight[:, None]).astype(np.float32)
    latent = np.array([r[1] @ v[r[0]] * norm for r, (_, norm) in zip(parts, owner)], np.float32)
    norms = np.linalg.norm(latent, axis=1)
    good = norms > 0
    good = np.flatnonzero(good)[np.argsort(norms[good], kind="stable")]
    return Space(number_of_term, vectors, latent[good] / norms[good, None], norms[good], np.array([i for i, _ in owner])[good])


def _renumbered(number: dict[bytes, int], terms: dict[bytes, int]) -> np.ndarray:
    """Per term its number in ``number``, -1 where it has none."""
    out = np.full(len(terms), -1, np.int64)
    for w, i in number.items():
        out[terms[w]] = i
    return out


def build_search(docs: DataFrame, items: list[tuple[int | None, list[bytes]]]) -> Search:
    terms = _terms(items)
    return _search(numbered(docs.select("text"), terms), items, terms)


def _search(rows: DataFrame, items: list[tuple[int | None, list[bytes]]], terms: dict[bytes, int]) -> Search:
    """``rows``: all documents as :func:`numbered` by ``terms``."""
    df, n = document_frequencies(rows, len(terms))
    idf = np.log((n + 1) / (df + 1))
    rare = np.maximum(0.0, idf - np.log(1 / COMMON))
    weighted = [sum(rare[terms[w]] > 0 for w in set(words)) >= min(LEAST_TERMS, len(set(words))) for _, words in items]
    spaces = []
    for flag, weight in ((True, rare), (False, idf + 0.1)):
        group = [(i, words) for i, (_, words) in enumerate(items) if weighted[i] == flag]
        of = {w: weight[terms[w]] for _, words in group for w in words if weight[terms[w]] > 0}
        if of:
            spaces.append(_space(rows, group, of, terms))
    of_terms = [(i, [terms[w] for w in words]) for i, words in items]
    return Search(of_terms, pa.array(list(terms), pa.large_binary()), spaces, _shared(items, terms, df))


def _shared(items: list[tuple[int | None, list[bytes]]], terms: dict[bytes, int], df: np.ndarray) -> Shared:
    held: dict[bytes, list[int]] = {}
    sizes, least = [], []
    for i, (_, words) in enumerate(items):
        n, count = len(words), Counter(words)
        need = math.ceil(least_of(n))
        hits = min(need, 1 + n // 5)  # more need commoner words, fewer leave more to the LCS check
        left = n - need + hits
        for w in sorted(count, key=lambda w: (df[terms[w]], w)):
            if left <= 0:
                break
            held.setdefault(w, []).append(i)
            left -= count[w]
        sizes.append(stretch(n))
        least.append(hits)
    first = np.cumsum([0, *map(len, held.values())])
    item = np.array([i for x in held.values() for i in x], np.int64)
    number = _renumbered({w: k for k, w in enumerate(held)}, terms)
    return Shared(number, first, item, np.array(sizes, np.int64), np.array(least, np.int64))


def _sharing(shared: Shared, terms: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """All candidates (document, first word of a stretch, item) of a few texts
    by shared words, from the numbers of their words (-1: none). Texts are cut into stretches of each item's length; one
    that an item could be in lies within two neighbouring ones."""
    ids = np.append(shared.number, -1)[terms]
    hit = np.flatnonzero(ids >= 0)
    if not len(hit):
        return
    text = np.repeat(np.arange(len(lengths)), lengths)[hit]
    place = hit - (np.cumsum(lengths) - lengths)[text]
    base = np.cumsum(lengths + 2) - (lengths + 2)  # no stretch is next to one of another text
    width = int(base[-1] + lengths[-1] + 2)
    start, pairs = shared.first[ids[hit]], np.diff(shared.first)[ids[hit]]
    ends = np.cumsum(pairs)
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = 0
    while a < len(hit):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - pairs[a] + PAIRS_AT_ONCE, "right")))
        of = np.repeat(np.arange(a, b), pairs[a:b])
        i = shared.item[start[of] + np.arange(len(of)) - (ends - pairs)[of] + (ends[a] - pairs[a])]
        new, n = np.unique(i * width + base[text[of]] + place[of] // shared.stretch[i], return_counts=True)
        keys, back = np.unique(np.concatenate((keys, new)), return_inverse=True)
        counts = np.bincount(back, np.concatenate((counts, n)), len(keys)).astype(np.int64)
        a = b
    following = np.append(np.where(np.diff(keys) == 1, counts[1:], 0), 0)
    i = keys // width
    ok = np.flatnonzero(counts + following >= shared.least[i])
    at = keys[ok] % width
    d = np.searchsorted(base, at, "right") - 1
    for x in zip(d.tolist(), ((at - base[d]) * shared.stretch[i[ok]]).tolist(), i[ok].tolist()):
        yield x


def _cosine(search: Search, i: int, words: np.ndarray) -> float:
    """Cosine of a passage and the nearest part of an item, 0 if the passage
    has no weight."""
    best = 0.0
    for space in search.spaces:
        mine = space.part_item == i
        known = np.append(space.number, -1)[words]
        known = known[known >= 0]
        if mine.any() and len(known):
            v = space.vectors[known].sum(0)
            best = max(best, float((space.parts[mine] @ v).max() / max(np.linalg.norm(v), 1e-9)))
    return best


def _windows(space: Space, terms: np.ndarray, lengths: np.ndarray):
    """Candidates (document, first word, item, cosine) of a few texts, from
    the numbers of their words (-1: none)."""
    rank = space.vectors.shape[1]
    blocks = -(-lengths // BLOCK_WORDS)
    first = np.cumsum(blocks + 3) - (blocks + 3)  # three empty blocks after each text
    total = int((blocks + 3).sum())
    ids = np.append(space.number, -1)[terms]
    text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    hit = np.flatnonzero(ids >= 0)
    if not len(hit):
        return
    at = first[text[hit]] + place[hit] // BLOCK_WORDS
    start = np.flatnonzero(np.diff(at, prepend=-1))
    sums = np.zeros((total + 3, rank), np.float32)
    sums[at[start]] = np.add.reduceat(space.vectors[ids[hit]], start, axis=0)
    owner = np.repeat(np.arange(len(blocks)), blocks + 3)
    real = np.arange(total) - first[owner] < blocks[owner]
    two = sums[:-1] + sums[1:]
    least = COVER * space.norms[0]
    for window in (two, two[:-2] + two[2:]):
        size = np.sqrt(np.einsum("ij,ij->i", window[:total], window[:total]))
        big = np.flatnonzero(real & (size >= least))  # a shorter passage cannot hold enough of any part
        big = big[np.argsort(size[big])]
        for i in range(0, len(big), WINDOWS_AT_ONCE):
            w = big[i : i + WINDOWS_AT_ONCE]
            parts = np.searchsorted(space.norms, size[w[-1]] / COVER * 1.0001, "right")  # nor of a longer part
            dot = window[w] @ space.parts[:parts].T
            r, c = np.nonzero((dot >= COSINE * size[w, None]) & (dot >= COVER * space.norms[:parts]))
            b, d = w[r], owner[w[r]]
            yield from zip(d.tolist(), ((b - first[d]) * BLOCK_WORDS).tolist(), space.part_item[c].tolist(), (dot[r, c] / size[b]).tolist())


def find_leaks(search: Search, terms: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, float, float, bool]]:
    """(text, item, cosine, LCS share, answer found) for a few texts, from the
    numbers of their words (-1: none)."""
    out = []
    terms = terms.astype(np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    done: dict[tuple[int, int], set] = {}
    place = np.zeros(len(search.terms) + 1, np.int64)  # of each term in one item; -1 is the last, in none

    def region(d: int, first: int, end: int) -> np.ndarray:
        return terms[begins[d] + max(0, first) : min(begins[d] + end, ends[d])]

    for space in search.spaces:
        found = sorted(_windows(space, terms, lengths), key=lambda c: (c[2], c[0], -c[3], c[1]))
        for i, candidates in itertools.groupby(found, key=lambda c: c[2]):
            sought = Sought(search.items[i][1])
            with _placed(place, sought.words):
                for d, start, _, cosine in candidates:
                    tried = done.setdefault((d, i), set())
                    if None in tried or start in tried:
                        continue
                    tried.add(start)
                    words = region(d, start - sought.n, start + 4 * BLOCK_WORDS + sought.n)
                    if sought.may_be_in(place[words]) and (got := sought.verify(words.tolist())):
                        tried.add(None)
                        out.append((d, i, cosine, *got))
    for i, candidates in itertools.groupby(_sharing(search.shared, terms, lengths), key=lambda c: c[2]):
        sought, size = Sought(search.items[i][1]), int(search.shared.stretch[i])
        with _placed(place, sought.words):
            for d, start, _ in candidates:
                tried = done.setdefault((d, i), set())
                if None not in tried:
                    words = region(d, start - size, start + 2 * size)
                    if sought.may_be_in(place[words]) and (got := sought.verify(words.tolist())):
                        tried.add(None)
                        out.append((d, i, _cosine(search, i, words), *got))
    return out


@contextmanager
def _placed(place: np.ndarray, terms: list[int]) -> Iterator[None]:
    place[terms] = np.arange(1, len(terms) + 1)
    yield
    place[terms] = 0


def _leaks_of(search: Search, terms: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, float, float, bool]]:
    """:func:`find_leaks` of any number of texts, about ``WORDS_AT_ONCE``
    words at a time."""
    ends = np.cumsum(lengths)
    i = 0
    while i < len(ends):
        a = int(ends[i] - lengths[i])
        j = max(i + 1, int(np.searchsorted(ends, a + WORDS_AT_ONCE, "right")))
        for d, *rest in find_leaks(search, terms[a : ends[j - 1]], lengths[i:j]):
            yield i + d, *rest
        i = j


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    block: list = []
    size = 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        words = words_of(r.text)
        if not words:
            continue
        block.append((r.item_id, words))
        size += len(r.text)
        if len(block) >= ITEMS_AT_ONCE or size >= BYTES_AT_ONCE:
            yield block
            block, size = [], 0
    if block:
        yield block


SCHEMA = "doc_id long, item_id long, cosine double, lcs_share double, answer boolean"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, lcs_share, answer``: a row for every
    document and benchmark item found in it."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = spark.createDataFrame([], SCHEMA)
    for items in _item_blocks(benchmark):
        terms = _terms(items)
        rows = numbered(texts, terms)
        shared = spark.sparkContext.broadcast(_search(rows, items, terms))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = shared.value
            for batch in batches:
                if got := list(_leaks_of(search, *_flat(batch, "term"))):
                    d, i, *rest = zip(*got)
                    of = pa.array([search.items[k][0] for k in i], pa.int64())
                    columns = [batch.column("doc_id").take(pa.array(d)), of, *map(pa.array, rest)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "cosine", "lcs_share", "answer"])

        found = found.unionByName(rows.mapInArrow(scan, SCHEMA))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. A row filter, so
    null and repeated ids need no care and no text is shuffled."""
    spark = docs.sparkSession
    for items in _item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(build_search(docs, items))
        docs = docs.where(_clean(shared)(F.coalesce(F.col("text"), F.lit(""))))
    return docs


def _clean(shared):
    """Function of a text column: no item of the broadcast search is in it."""

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hold_alone("none", int)
        for s in batches:
            ok = np.ones(len(s), bool)
            terms, lengths = _numbers(pa.array(s, pa.large_string()), shared.value.terms)
            ok[[d for d, *_ in _leaks_of(shared.value, terms, lengths)]] = False
            yield pd.Series(ok)

    return clean


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id`` of documents that hold a benchmark item, once each."""
    return leaks(docs, benchmark).select("doc_id").distinct()
