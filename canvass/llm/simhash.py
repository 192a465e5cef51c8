"""Near-duplicate documents by SimHash, compared exactly in tiles.

Fingerprint: words are runs of other than ASCII white space after A-Z is
lower-cased; every ``shingle`` consecutive words joined by a space (repeats
included; a shorter text is one shingle) give an XXH64 with seed 42, and a
bit is set if it is set in over half of the hashes. A text without words has
fingerprint zero and links like any other.

Links (at most ``radius`` differing bits) are found by comparing distinct
fingerprints in tiles with numpy exclusive-or and bit counts. A tile holds
fingerprints whose two halves have the same population counts; two
fingerprints differ in at least the sum of the differences of these counts,
so tile pairs beyond the radius are skipped and every other pair is compared
in full. Large tiles are dealt into parts, and the tiles one is compared to
into bundles of about a tile's rows, so a group of rows that a task reads is
a tile and a bundle, at most about ``3 * TILE_MOST`` fingerprints.
A task reduces its links to a spanning forest, so a group of copies sends a
row per copy and not per pair; the components are those of all links. Copies
of one fingerprint are collapsed before and joined back after.

Work grows with the square of the number of distinct fingerprints (that is
the method); what is shuffled is a fingerprint per neighbouring tile and
bundle.

Edge cases: null text counts as empty; null ids keep a row and take the
component id of the others in their component (null if all are null);
repeated rows stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canvass.llm.common import hold_alone, id_hash, materialise
from canvass.llm.components import connected_components

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE_ROWS = 32_768
TILES = 256  # beyond about as many, tiles grow first ...
TILE_MOST = 1 << 20  # ... up to this, then their number again
HALF = (1 << 32) - 1


def fingerprint_bytes(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of UTF-8 text."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = xxhash.xxh64_digest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops)])
    raw = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for i in range(0, len(raw), 8192):
        total += np.unpackbits(raw[i : i + 8192], axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > len(raw))
    return int(bits.view(">i8")[0])


def simhash(text: Column, shingle: int = SHINGLE) -> Column:
    def values(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hold_alone("none", int)
        for s in batches:
            yield pd.Series([fingerprint_bytes((t or "").encode(), shingle) for t in s], dtype="int64")

    return F.pandas_udf(values, T.LongType())(F.coalesce(text, F.lit("")))


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Spanning forest of index pairs given in blocks."""
    label = np.arange(n)
    edges: list[tuple[int, int]] = []
    for a, b in pairs:
        la, lb = label[a], label[b]
        new = la != lb
        if not new.any():
            continue
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := parent.get(x, x)) != x:
                parent[x] = parent.get(y, y)
                x = parent[x]
            return x

        _, first = np.unique(la[new] * n + lb[new], return_index=True)
        for i, j, x, y in zip(a[new][first].tolist(), b[new][first].tolist(), la[new][first].tolist(), lb[new][first].tolist()):
            if (rx := root(x)) != (ry := root(y)):
                parent[max(rx, ry)] = min(rx, ry)
                edges.append((i, j))
        move = np.arange(n)
        for x in parent:
            move[x] = root(x)
        label = move[label]
    return edges


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int, rows: int = 256, cols: int = 4096):
    """Index pairs (left, right) within ``radius`` bits, block by block."""
    buffer = np.empty((rows, cols), np.uint64)
    counts = np.empty((rows, cols), np.uint8)
    for i in range(0, len(left), rows):
        a = left[i : i + rows, None]
        for j in range(0, len(right), cols):
            b = right[None, j : j + cols]
            x, c = buffer[: len(a), : b.shape[1]], counts[: len(a), : b.shape[1]]
            np.bitwise_xor(a, b, out=x)
            np.bitwise_count(x, out=c)
            hit = c <= radius
            if hit.any():
                p, q = np.nonzero(hit)
                yield p + i, q + j


def deal(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, tile, g, left, first``: the fingerprints of every group ``g``, which
    compares tile ``left`` to a bundle of near tiles with higher numbers (the
    first bundle holds the tile itself too).

    A cell (population counts of both halves) is cut into tiles, numbered
    through all cells. Seen from a cell, the near cells from itself up lie on
    a line, and a bundle is the tiles that begin in a stretch of it as long as
    a tile. So tiles, groups and bundles are computed from a row per cell (33
    x 33 at most); there is no list of them."""
    low = F.bit_count(F.col("fp").bitwiseAND(F.lit(HALF)))
    cells = fingerprints.select("fp", low.alias("a"), (F.bit_count("fp") - low).alias("b"))
    sizes = {(r.a, r.b): r.n for r in cells.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).collect()}
    tile_rows = max(TILE_ROWS, min(TILE_MOST, sum(sizes.values()) // TILES))
    parts = {c: -(-n // tile_rows) for c, n in sizes.items()}
    rows_each = {c: -(-n // parts[c]) for c, n in sizes.items()}
    first, top, number = {}, {}, 0
    lefts: dict[tuple[int, int], list[tuple]] = {c: [] for c in sizes}  # of a cell: the cells that see it
    for c in sorted(sizes):
        first[c], number, place = number, number + parts[c], 0
        for near in sorted(n for n in sizes if n >= c and abs(n[0] - c[0]) + abs(n[1] - c[1]) <= radius):
            lefts[near].append((first[c], parts[c], rows_each[c], place, near == c))
            top[c] = (place + (parts[near] - 1) * rows_each[near]) // tile_rows
            place += sizes[near]
    span = max(top.values(), default=0) + 1
    rows = [(*c, parts[c], rows_each[c], first[c], top[c], lefts[c]) for c in sizes]
    seen = "lefts array<struct<first: long, parts: long, each: long, place: long, same: boolean>>"
    plan = fingerprints.sparkSession.createDataFrame(rows, f"a int, b int, parts long, each long, start long, top long, {seen}")
    cells = cells.join(F.broadcast(plan), ["a", "b"]).withColumn("s", F.pmod(id_hash(F.col("fp")), F.col("parts")))

    def begins(s: Column, each: Column, place: Column | int = 0) -> Column:
        return F.floor((place + s * each) / tile_rows)

    def group(left: Column, bundle: Column, own: Column) -> Column:
        return F.struct((left * span + bundle).alias("g"), left.alias("left"), (bundle == own).alias("first"))

    def counted(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))

    def seen_from(c: Column) -> Column:
        bundle = begins(F.col("s"), F.col("each"), c["place"])
        tiles = counted(F.when(c["same"], F.col("s")).otherwise(c["parts"]))
        return F.transform(tiles, lambda i: group(c["first"] + i, bundle, begins(i, c["each"])))

    own = begins(F.col("s"), F.col("each"))
    tile = F.col("start") + F.col("s")
    as_left = F.transform(F.sequence(own, F.col("top")), lambda x: group(tile, x, own))
    as_right = F.flatten(F.transform("lefts", seen_from))
    dealt = cells.select("fp", tile.alias("tile"), F.explode(F.concat(as_left, as_right)).alias("of"))
    return dealt.select("fp", "tile", "of.g", "of.left", "of.first")


def simhash_links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``u, v``: links that connect all fingerprints (column ``fp``, distinct)
    within ``radius`` bits of each other, as spanning forests per group."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(pdf["tile"].to_numpy(), kind="stable")
        fp, tile = fp[order], pdf["tile"].to_numpy()[order]
        # bundles hold tiles numbered from the left one up, so it sorts first
        mine = np.searchsorted(tile, pdf["left"].iloc[0], "right")
        skip = 0 if pdf["first"].iloc[0] else mine
        edges = _forest(len(fp), ((p, q + skip) for p, q in close_pairs(fp[:mine], fp[skip:], radius)))
        i = np.array(edges, np.int64).reshape(-1, 2)
        v = fp.view(np.int64)
        return pd.DataFrame({"u": v[i[:, 0]], "v": v[i[:, 1]]})

    return deal(fingerprints, radius).groupBy("g").applyInPandas(compare, "u long, v long")


def _classes(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root, component_id) of every
    fingerprint."""
    prints = materialise(docs.select("doc_id", simhash(F.col("text"), shingle).alias("fp")), "simhash")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = connected_components(simhash_links(distinct.select("fp"), radius))
    of = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = of.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints, of.join(lowest, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``: the smallest
    doc_id reachable over links, its own included."""
    prints, of = _classes(docs, shingle, radius)
    of = of.select(F.col("fp").alias("of_fp"), "component_id")
    return prints.join(of, F.col("fp") == F.col("of_fp")).select("doc_id", "fp", "component_id")


def simhash_classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits)``, component_id``."""
    c = simhash_components(docs, shingle, radius)
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one of smallest doc_id.
    Rows with a null or repeated id, which an id cannot tell apart, are found
    by their fingerprints, and one of equal ones stays (null ids last)."""
    prints, of = _classes(docs, shingle, radius)
    of = of.select(F.col("fp").alias("of_fp"), "root")
    rows = prints.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n")).join(of, F.col("fp") == F.col("of_fp"))
    rows = materialise(rows.select("doc_id", "fp", "n", "root"), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("first")
    chosen = materialise(rows.groupBy("root").agg(first).select("first.doc_id", "first.fp"), "simhash-chosen")
    odd = rows.groupBy("doc_id").agg(F.sum("n").alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull()).select("doc_id")
    odd = materialise(odd, "simhash-odd")
    stay = docs.join(rows.join(chosen, ["doc_id", "fp"], "left_anti").select("doc_id").unionByName(odd), "doc_id", "left_anti")
    stay = stay.where(F.col("doc_id").isNotNull())
    if not odd.limit(1).count():
        return stay.select(*docs.columns)
    some = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("whole"))
    some = some.join(odd, F.col("id").eqNullSafe(odd["doc_id"]), "left_semi").withColumn("print", simhash(F.col("whole"), shingle))
    some = some.join(chosen, F.col("id").eqNullSafe(chosen["doc_id"]) & (F.col("print") == chosen["fp"]), "left_semi")
    return stay.select(*docs.columns).unionByName(some.dropDuplicates(["id", "print"]).select("row.*"))
