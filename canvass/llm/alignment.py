"""Alignment of two tokenizers' tokens over the same text.

A byte-level tokenizer A encodes a space and the text, a sentencepiece model
B (which adds that space itself) the text, both without special tokens; the
strings of special tokens inside a text are plain text. The end offsets of
the tokens in UTF-8 bytes are two ascending lists. The shorter list drives a
galloping intersection: from the place of an element already found, steps of
1, 2, 4, ... overtake the next one in the longer list and a binary search
ends it (``gallop_ranks``; elements at ever smaller strides of a batch, so
that every step is one array operation). Ends in both lists cut the tokens
into groups, and the difference of two neighbouring ranks is the range of
tokens of the longer list that a token of the shorter one overlaps.

How many documents of the corpus hold a pair of ids linked is counted in
three steps that never hold a row per document and pair: a task deals its
documents into blocks of about ``BLOCK_BYTES`` of text and keeps each block's
distinct pairs with their documents; the blocks' rows are summed per pair;
and the sums go back to the blocks, where the documents' own pairs, kept as
places in the block's list, meet them. A pair that is in every document is
one row a block.

Before a single space between two other characters both tokenizers end a
token whatever follows (``Models`` checks this once; other models encode whole
texts), and before a single line end too. So a text goes through in units,
its words, and units that recur in ``TEXT_AT_ONCE`` of text are encoded and
aligned once; a stretch of ``UNIT_CHARS`` without such a space is cut at line
ends. Memory therefore depends on the sizes above; a text without such a
place is one unit, whose encoding takes some hundred bytes a byte.

Edge cases: null and empty texts, and texts whose bytes A or B does not give
back (B normalises some), have no tokens: zeros and an empty digest. Every
row is a document: repeated rows and repeated or null ids count once each.
Ties of counts are all highest. An empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canvass.llm.common import by_bytes, materialise
from canvass.llm.token_count import MARK, processor, tokenizer_path

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
UNIT_CHARS = 1 << 15
CALL_BYTES, TEXT_AT_ONCE, BLOCK_CHARS = 1 << 19, 4 << 20, 16 << 20
MERGE_AT = 64
_CUT = re.compile(rf"(?<=[^\s{MARK}])(?: (?=[^\s{MARK}])|(?=\n[^\s{MARK}]))")
_SPACE = re.compile(rf"(?<=[^\s{MARK}]) (?=[^\s{MARK}])")
_LAST = np.iinfo(np.int64).max


def gallop_ranks(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each element of ``short`` the number of smaller ones in ``long``
    (both strictly ascending)."""
    n = len(short)
    rank = np.zeros(n, np.int64)
    if not n:
        return rank
    ahead = np.append(long, _LAST)
    rank[:1] = _gallop(ahead, short[:1], np.zeros(1, np.int64))
    stride = 1 << (n - 1).bit_length()
    while stride:
        at = np.arange(stride, n, 2 * stride)
        if len(at):
            rank[at] = _gallop(ahead, short[at], rank[at - stride])
        stride >>= 1
    return rank


def _gallop(ahead: np.ndarray, x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """First places from ``start`` on whose element is not below ``x``;
    ``ahead`` ends in an element above all."""
    top = len(ahead) - 1
    below, above = start - 1, start.copy()
    step = 1
    todo = np.flatnonzero(ahead[above] < x)
    while len(todo):
        below[todo] = above[todo]
        above[todo] = np.minimum(above[todo] + step, top)
        todo = todo[ahead[above[todo]] < x[todo]]
        step *= 2
    todo = np.flatnonzero(above - below > 1)
    while len(todo):
        middle = (above[todo] + below[todo]) >> 1
        less = ahead[middle] < x[todo]
        below[todo[less]] = middle[less]
        above[todo[~less]] = middle[~less]
        todo = todo[above[todo] - below[todo] > 1]
    return above


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place in A, place in B) of every overlapping token pair in text
    order, and which ends of A and of B are common. The last ends are equal."""
    swap = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    rank = gallop_ranks(short, long)
    common = long[rank] == short
    first = np.zeros_like(rank)
    first[1:] = rank[:-1] + common[:-1]
    width = rank - first + 1
    own = np.repeat(np.arange(len(short)), width)
    other = np.arange(len(own)) + np.repeat(first - (np.cumsum(width) - width), width)
    common_long = np.zeros(len(long), bool)
    common_long[rank[common]] = True
    return (other, own, common_long, common) if swap else (own, other, common, common_long)


def token_bytes(piece: str, is_byte: bool) -> bytes:
    """Bytes of a sentencepiece entry."""
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(MARK, " ").encode()


def byte_symbols() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


class Models:
    """Both tokenizers with the bytes, lengths and decimal texts of their ids."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer_path(a))
        self.a.encode_special_tokens = True
        self.b = processor(b)
        symbols = byte_symbols()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (1 + max(entries.values(), default=0))
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(symbols[c] for c in entry) if all(c in symbols for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [token_bytes(p, self.b.is_byte(i)) for i, p in enumerate(pieces)]
        self.size_a, self.size_b = len(self.bytes_a), len(pieces)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        ids = [*range(self.size_a)], [*range(self.size_b)]
        ended = [f"{i}{s}" for i in ids[0] for s in ",|"] + [f"{i}{s}" for i in ids[1] for s in ",;"]
        self.decimal = np.array(ended, object)
        self.cuts = self._cuts(pieces)

    def _cuts(self, pieces: list[str]) -> bool:
        """Neither model has a token that crosses a cut, and both treat the
        text behind one as its own."""
        if any(MARK in p[1:] and p.strip(MARK) for p in pieces) or any("\n" in p and len(p) > 1 for p in pieces):
            return False
        a, b = self.encode([" x. y\nz"])
        parts = self.encode([" x.", " y", "\nz"])
        return a[0] == sum(parts[0], []) and b[0] == sum(parts[1], [])

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for units as :func:`units` gives them. B adds a
        mark itself: a unit's own space goes before, and where it starts with
        a line end the mark goes after."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = self.b.encode([u.removeprefix(" ") for u in units], num_threads=1)
        return a, [ids if u[0] == " " else ids[1:] for u, ids in zip(units, b)]


@lru_cache(maxsize=2)
def models(a: str, b: str) -> Models:
    return Models(a, b)


def units(text: str, cuts: bool, limit: int = UNIT_CHARS) -> Iterator[list[str]]:
    """The units of a space and ``text`` in order, in lists of about ``limit``
    (at least 1) characters: words at single spaces, and in a stretch without one lines."""
    if not cuts:
        yield [f" {text}"]
        return
    start, before = 0, " "
    while True:
        m = _CUT.search(text, start + limit) if len(text) - start > limit else None
        words = _SPACE.split(text[start : m.start() if m else len(text)])
        yield [before + words[0], *[f" {w}" for w in words[1:]]]
        if not m:
            return
        before, start = m.group(), m.end()


class Aligned:
    """Distinct units with what their alignment gives: numbers of tokens and
    groups, the pairs of the links (those of unit i from ``first[i]`` to
    ``first[i + 1]``), the groups as text, and whether the bytes are right."""

    def __init__(self, m: Models, found: list[str]):
        parts = [_align_call(m, call) for call in by_bytes(found, CALL_BYTES)]
        self.n_a, self.n_b, self.groups, self.n_links, self.codes, self.ok = (np.concatenate([p[i] for p in parts]) for i in range(6))
        self.text = [t for p in parts for t in p[6]]
        self.first = np.concatenate([[0], np.cumsum(self.n_links)])


def _align_call(m: Models, found: list[str]) -> tuple:
    all_a, all_b = m.encode(found)
    n_a = np.fromiter(map(len, all_a), np.int64, len(found))
    n_b = np.fromiter(map(len, all_b), np.int64, len(found))
    ok = np.ones(len(found), bool)
    for i, (u, x, y) in enumerate(zip(found, all_a, all_b)):
        ok[i] = b"".join([m.bytes_a[t] for t in x]) == u.encode() == b"".join([m.bytes_b[t] for t in y])
    n_a[~ok] = n_b[~ok] = 0
    if not ok.any():
        none = np.zeros(len(found), np.int64)
        return n_a, n_b, none, none, none[:0], ok, [""] * len(found)
    a = np.fromiter(chain.from_iterable(compress(all_a, ok)), np.int64, n_a.sum())
    b = np.fromiter(chain.from_iterable(compress(all_b, ok)), np.int64, n_b.sum())
    # units stand behind one another, so their bounds are common ends too
    link_a, link_b, common_a, common_b = overlaps(np.cumsum(m.length_a[a]), np.cumsum(m.length_b[b]))
    unit = np.repeat(np.arange(len(found)), n_a)
    groups = np.bincount(unit, common_a, len(found)).astype(np.int64)
    n_links = np.bincount(unit[link_a], minlength=len(found))
    # A's tokens of a group stand before B's: every place moves by the other's
    last_a, last_b = np.flatnonzero(common_a) + 1, np.flatnonzero(common_b) + 1
    before = np.concatenate([[0], last_b])
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + before[np.cumsum(common_a) - common_a]] = 2 * a + common_a
    order[np.arange(len(b)) + last_a[np.cumsum(common_b) - common_b]] = 2 * (m.size_a + b) + common_b
    written = m.decimal[order].tolist()
    to = np.cumsum(n_a + n_b).tolist()
    text = ["".join(written[lo:hi])[:-1] for lo, hi in zip([0, *to], to)]
    return n_a, n_b, groups, n_links, a[link_a] * m.size_b + b[link_b], ok, text


class Found:
    """What is known of one document while its units come in."""

    def __init__(self, doc_id: int | None, whole: bool):
        self.doc_id, self.whole = doc_id, whole
        self.ok, self.a, self.b, self.groups, self.links = True, 0, 0, 0, 0
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.text: list[str] = []
        self.sha = hashlib.sha256()

    def add(self, a: int, b: int, groups: int, codes: np.ndarray, times: np.ndarray, text: str) -> None:
        text = f";{text}" if self.a else text
        self.text.append(text) if self.whole else self.sha.update(text.encode())
        self.a, self.b, self.groups, self.links = self.a + a, self.b + b, self.groups + groups, self.links + int(times.sum())
        self.codes.append(codes)
        self.times.append(times)
        if len(self.codes) == MERGE_AT:
            self.merge()

    def merge(self) -> None:
        codes, place = np.unique(np.concatenate([np.empty(0, np.int64), *self.codes]), return_inverse=True)
        times = np.bincount(place, np.concatenate([np.empty(0, np.int64), *self.times]), len(codes)).astype(np.int64)
        self.codes, self.times = [codes], [times]

    def row(self) -> tuple:
        if not self.ok or not self.a:
            return self.doc_id, 0, 0, 0, 0, ""
        return self.doc_id, self.a, self.b, self.groups, self.links, "".join(self.text) if self.whole else self.sha.hexdigest()


def align_call(m: Models, docs: list[tuple[Found, list[str]]]) -> None:
    """Align the units of some documents, equal ones once, and give every
    document its own."""
    number: dict[str, int] = {}
    use = [np.array([number.setdefault(u, len(number)) for u in own]) for _, own in docs]
    if not number:
        return
    al = Aligned(m, list(number))
    unit = np.concatenate(use)
    owner = np.repeat(np.arange(len(use)), [len(x) for x in use])
    bad = np.bincount(owner, ~al.ok[unit], len(use)) > 0
    a, b, groups = (np.bincount(owner, x[unit], len(use)).astype(np.int64) for x in (al.n_a, al.n_b, al.groups))
    width = al.n_links[unit]
    at = np.arange(width.sum()) + np.repeat(al.first[unit] - (np.cumsum(width) - width), width)
    pairs = m.size_a * m.size_b
    keys, times = np.unique(np.repeat(owner, width) * pairs + al.codes[at], return_counts=True)
    cut = np.searchsorted(keys, np.arange(len(use) + 1) * pairs)
    for i, (found, _) in enumerate(docs):
        if bad[i]:
            found.ok = False
        elif found.ok:
            lo, hi = cut[i], cut[i + 1]
            text = ";".join([al.text[u] for u in use[i].tolist()])
            found.add(int(a[i]), int(b[i]), int(groups[i]), keys[lo:hi] - i * pairs, times[lo:hi], text)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCKS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, step array<int>, times array<int>, codes array<long>, held array<int>"


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *parts]), kind))


def _block_rows(block: int, done: list[Found]) -> pa.RecordBatch:
    """A block's documents; the first row holds the block's distinct pairs
    and in how many of its documents each stands, every row its own pairs as
    steps between places in that list."""
    for f in done:
        f.merge()
        if not f.ok:
            f.codes, f.times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    codes, place, held = np.unique(np.concatenate([f.codes[0] for f in done]), return_inverse=True, return_counts=True)
    split = np.split(place, np.cumsum([len(f.codes[0]) for f in done])[:-1])
    rows = [f.row() for f in done]
    none = pa.nulls(len(rows) - 1, pa.list_(pa.int64())), pa.nulls(len(rows) - 1, pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(rows), pa.int64()),
            *(pa.array([r[i] for r in rows], pa.int64()) for i in range(5)),
            pa.array([r[5] for r in rows], pa.string()),
            _lists([np.diff(p, prepend=0) for p in split], pa.int32()),
            _lists([f.times[0] for f in done], pa.int32()),
            pa.concat_arrays([_lists([codes], pa.int64()), none[0]]),
            pa.concat_arrays([_lists([held], pa.int32()), none[1]]),
        ],
        names=["block", "doc_id", *_NUMBERS, "groups", "step", "times", "codes", "held"],
    )


def aligned_blocks(docs: DataFrame, whole_groups: bool = False, a: str = MODEL_A, b: str = MODEL_B) -> DataFrame:
    """The documents in blocks (see ``_block_rows``), written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = models(a, b)
        task, block, size, waiting = TaskContext.get().partitionId(), 0, 0, 0
        done: list[Found] = []
        call: list[tuple[Found, list[str]]] = []

        def flush() -> None:
            nonlocal waiting
            align_call(m, call)
            call.clear()
            waiting = 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                done.append(Found(doc_id, whole_groups))
                for own in units(text, m.cuts) if text else ():
                    call.append((done[-1], own))
                    n = sum(map(len, own))
                    waiting, size = waiting + n, size + n
                    if waiting >= TEXT_AT_ONCE:
                        flush()
                if size >= BLOCK_CHARS:
                    flush()
                    yield _block_rows(task << 32 | block, done)
                    done, block, size = [], block + 1, 0
        flush()
        if done:
            yield _block_rows(task << 32 | block, done)

    return materialise(docs.select("doc_id", "text").mapInArrow(run, _BLOCKS), "aligned")


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """``code, held, highest``: how many documents hold the pair linked, and
    whether no pair with its A id is held by more (at most one row per entry
    of B's vocabulary stands in a window)."""
    pairs = blocks.where("codes is not null").select(F.explode(F.arrays_zip("codes", "held")).alias("p"))
    sums = pairs.groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.held").alias("held"))
    of_a = Window.partitionBy(F.floor(F.col("code") / F.lit(size_b)))
    return sums.withColumn("highest", F.col("held") == F.max("held").over(of_a))


def _weigh(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """``n_best`` and ``count_sum`` of a block's documents."""
    docs = docs.combine_chunks()
    order = np.argsort(counts["place"].to_numpy())
    held, highest = counts["held"].to_numpy()[order], counts["highest"].to_numpy(zero_copy_only=False)[order]
    step, times = docs["step"].combine_chunks(), docs["times"].combine_chunks()
    step, times = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (step, times))
    to = np.cumsum(pa.compute.list_value_length(step).to_numpy())
    width = np.diff(to, prepend=0)
    walk = np.concatenate([[0], np.cumsum(step.flatten().to_numpy().astype(np.int64))])
    at = walk[1:] - np.repeat(walk[to - width], width)
    times = times.flatten().to_numpy().astype(np.int64)

    def per_row(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[to] - total[to - width]

    out = docs.select(["doc_id", *_NUMBERS])
    out = out.append_column("n_best", pa.array(per_row(times * highest[at]), pa.int64()))
    out = out.append_column("count_sum", pa.array(per_row(times * held[at]), pa.int64()))
    return out.append_column("groups", docs["groups"])


def align_documents(docs: DataFrame, whole_groups: bool = False, a: str = MODEL_A, b: str = MODEL_B) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups``. ``groups`` is the text
    ``a1,a2|b1;a3|b2,b3`` of the ids, or its SHA-256 unless ``whole_groups``."""
    blocks = aligned_blocks(docs, whole_groups, a, b)
    counts = pair_counts(blocks, processor(b).get_piece_size())
    pairs = blocks.where("codes is not null").select("block", F.posexplode("codes").alias("place", "code"))
    known = pairs.join(counts, "code").select(F.col("block").alias("of_block"), "place", "held", "highest")
    rows = blocks.select("block", "doc_id", *_NUMBERS, "groups", "step", "times")
    return (
        rows.groupBy("block")
        .cogroup(known.groupBy("of_block"))
        .applyInArrow(_weigh, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    )
