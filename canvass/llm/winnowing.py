"""Document fingerprints by winnowing.

Every run of ``K`` code points (a k-gram) has a rolling 64-bit hash, mixed to
32 bits. From each window of ``W`` consecutive k-grams the smallest hash is
kept, the rightmost among equals, once, with its position. Any passage of
``W + K - 1`` code points shared by two texts therefore leaves at least one
common hash in both, at positions that show where, and no common passage
under ``K`` ever matches.

``likeness`` of two fingerprints is the Jaccard index of their hash sets.

The fingerprint as text has ten hex digits an entry: the hash (eight) and the
distance from the entry before (two; below ``W``), so positions are running
sums of the distances.

Edge cases: null is the empty text, whose fingerprint is empty; a text
shorter than ``K`` has one entry, the hash of the whole; a text with fewer
than ``W`` k-grams is one window; two empty fingerprints are alike (1.0), an
empty and another are not (0.0). Documents are ordered by descending doc_id,
null ids last, equal ids by a hash of the text; a table of one row follows
itself. Rows that repeat an id, or have none, are kept and spread over ranges
by their texts; rows equal in both stand in one range and cost one comparison.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import free_name, materialise

K, W = 24, 48
PART_BYTES = 24 << 20
PARTS_MOST = 100_000
WEIGHT = 4096
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)
_FIRST = -(1 << 63)
_ENTRY = np.dtype([("hash", ">u4"), ("gap", "u1")])


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_M1), n, 1 << 64))


def kgram_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hashes (as uint64) of all k-grams of a code point array, by
    joining hashes of 1, 2, 4, ... code points; one hash of everything if the
    array is shorter than ``k``."""
    k = min(k, len(codes))
    if not k:
        return np.empty(0, np.uint64)
    h = codes.astype(np.uint64) + np.uint64(1)
    h = (h ^ (h * _M1 >> _S32)) * _M2
    whole, have, size = None, 0, 1
    while True:
        if k & size:
            if whole is None:
                whole, have = h, size
            else:
                n = len(codes) - have - size + 1
                whole = whole[:n] * _power(size) + h[have : have + n]
                have += size
        if size * 2 > k:
            break
        h = h[:-size] * _power(size) + h[size:]
        size *= 2
    whole = (whole ^ (whole >> _S32)) * _M2
    return whole >> _S32


def window_minima(hashes: np.ndarray, w: int = W) -> np.ndarray:
    """Positions kept: the rightmost smallest hash of each window."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64)
    w = min(w, n)
    low = np.uint64(0xFFFFFFFF)
    m = (hashes << _S32) | (low - np.arange(n, dtype=np.uint64))
    size = 1
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < w:
        m = np.minimum(m[: n - w + 1], m[w - size :])
    keep = np.empty(len(m), bool)
    keep[0] = True
    np.not_equal(m[1:], m[:-1], out=keep[1:])
    return (low - (m[keep] & low)).astype(np.int64)


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) kept for a text."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    h = kgram_hashes(codes, k)
    at = window_minima(h, w)
    return h[at], at


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    out = np.empty(len(hashes), _ENTRY)
    out["hash"] = hashes
    out["gap"] = np.diff(positions, prepend=0)
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sorted arrays of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprint_documents(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """``docs`` with ``winnow_hashes`` (array<long>) and ``winnow_positions``
    (array<int>) added; columns of these names are replaced."""

    @F.pandas_udf("h array<long>, p array<int>")
    def entries(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            got = [winnow(t or "", k, w) for t in s]
            yield pd.DataFrame({"h": [h.astype(np.int64) for h, _ in got], "p": [p.astype(np.int32) for _, p in got]})

    name = free_name("_w", docs)
    found = docs.withColumn(name, entries(F.coalesce(F.col("text"), F.lit(""))))
    made = F.col(name)
    return found.withColumn("winnow_hashes", made["h"]).withColumn("winnow_positions", made["p"]).drop(name)


def _packed(k: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(k, h) pairs as 16 bytes that compare like them."""
    sign = np.uint64(1 << 63)
    pairs = np.stack((k.astype(np.int64).view(np.uint64) ^ sign, h.astype(np.int64).view(np.uint64) ^ sign), 1)
    return np.ascontiguousarray(pairs.astype(">u8")).view("S16").ravel()


def _part_of(cuts: np.ndarray):
    """Number of the range of a (k, h) pair; ``cuts`` are the last pairs of
    all ranges but the highest, ascending."""

    @F.pandas_udf("int")
    def number(k: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, _packed(k.to_numpy(), h.to_numpy()), "left").astype(np.int32))

    return number


def with_next(docs: DataFrame) -> DataFrame:
    """``part, own, k, h, doc_id, text``: rows dealt out by ranges of (doc_id,
    hash of the text) and sorted, so that the next document in descending
    order is the row before. The last row before a range (and for the lowest
    range the highest row of all) stands first in it with ``own`` false.

    Ranges are even in rows plus ``WEIGHT`` bytes of text; rows that share an
    id, or have none, spread over as many ranges as they need. The driver
    takes two rows per range; there is a range per ``PART_BYTES`` or shuffle
    partition and never more than ``PARTS_MOST``, beyond which ranges grow (a
    task sorts its range on disk and holds one row of it)."""
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(_FIRST)).alias("k")
    ).withColumn("h", F.xxhash64("text"))
    keys = materialise(rows.select("k", "h", F.octet_length("text").alias("size")), "winnow-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = min(PARTS_MOST, max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-total // PART_BYTES)))
    weighted = keys.select("k", "h", F.explode(F.sequence(F.lit(0), F.floor(F.col("size") / WEIGHT).cast("int"))).alias("w"))
    ranges = weighted.repartitionByRange(parts, "k", "h").groupBy(F.spark_partition_id().alias("r"))
    last = ranges.agg(F.max(F.struct("k", "h")).alias("m")).select("m.k", "m.h").toPandas().sort_values(["k", "h"])
    cuts = _packed(last["k"].to_numpy(), last["h"].to_numpy())[:-1]

    part_of = _part_of(cuts)
    top = keys.groupBy(part_of("k", "h").alias("part")).agg(F.max(F.struct("k", "h")).alias("m"))
    top = top.select("part", "m.k", "m.h").toPandas().sort_values("part")
    ends, after = _packed(top["k"].to_numpy(), top["h"].to_numpy()), np.roll(top["part"].to_numpy(), -1)

    @F.pandas_udf("array<int>")
    def places(k: pd.Series, h: pd.Series) -> pd.Series:
        pair = _packed(k.to_numpy(), h.to_numpy())
        own = np.searchsorted(cuts, pair, "left")
        i = np.minimum(np.searchsorted(ends, pair, "left"), len(ends) - 1)
        end = ends[i] == pair
        return pd.Series([[p, a] if e else [p] for p, a, e in zip(own.tolist(), after[i].tolist(), end.tolist())])

    dealt = rows.select("k", "h", "doc_id", "text", F.posexplode(places("k", "h")).alias("place", "part"))
    dealt = dealt.select("part", (F.col("place") == 0).alias("own"), "k", "h", "doc_id", "text")
    return dealt.repartitionById(parts, "part").sortWithinPartitions("part", "own", "k", "h", "text")


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of :func:`with_next` in their order; only the row before is held."""
    part, near, last, made = None, None, None, None  # range, text before, its hashes, the row made of a copy of it
    for pdf in batches:
        out = []
        for p, own, doc, text in zip(pdf["part"].tolist(), pdf["own"].tolist(), pdf["doc_id"].tolist(), pdf["text"].tolist()):
            if p != part:
                part, near, last, made = p, None, None, None
            if not own:
                if text != near:
                    near, last = text, None
                continue
            if made is None or text != near:
                h, at = winnow(text)
                if last is None:
                    last = np.unique(winnow(near)[0])
                kept = np.unique(h)
                row = _row(text, near, h, at, kept, last)
                made = row if text == near else None
                near, last = text, kept
            else:
                row = made
            out.append((None if pd.isna(doc) else int(doc), *row))
        yield pd.DataFrame(out, columns=COLUMNS).astype({"doc_id": "Int64"})


def _row(text: str, near: str, h: np.ndarray, at: np.ndarray, kept: np.ndarray, last: np.ndarray) -> tuple:
    n = len(text)
    cut = n // 3
    edited = text[: n - cut] + near[:cut]
    eh, ep = winnow(edited)
    sha = hashlib.sha256(edited.encode()).hexdigest()
    return n, sha, as_text(h, at), as_text(eh, ep), likeness(kept, np.unique(eh)), likeness(kept, last)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last third of
    its code points replaced by the first as many of the next document), and
    the likeness of the text's to the edited text's and the next text's."""
    return with_next(docs).mapInPandas(
        _compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
