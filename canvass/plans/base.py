"""Shared bases that several reports re-aggregate.

* :func:`vote_base`      votes by (contest, candidate, matched, region,
                         province): one pass over the fact table feeds the
                         national, local, per-province, leader and
                         per-region tallies (sums are additive, so exact).
* :func:`precinct_base`  one deterministic row per precinct: feeds turnout,
                         spoiled ballots, voter statistics, denominators.
* :func:`reception_pairs` one row per (reception text, precinct); from it
                         :func:`reception_counts` (merged rows per text) and
                         :func:`reception_times` (first parsed time per
                         precinct).

They are small next to the fact table (bounded by contests x provinces x
candidates, by precincts, and by machines x reception texts), which is why
the job materialises them once instead of caching the wide merged fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.operators import first_row_per_key, join_dimension, pack, unpack
from canvass.operators.joins import catalyst_broadcasts
from canvass.sources.bundle import Election

# Fixed order that picks the representative row of a precinct: lowest
# contest, then candidate, then the per-row counters, then precinct
# attributes (these only differ when CLUSTERED_PREC is duplicated).
RESULT_ORDER = ("CONTEST_CODE", "CANDIDATE_CODE", "UNDERVOTE", "OVERVOTE", "NUMBER_VOTERS")
PRECINCT_ORDER = ("PRV_NAME", "REG_NAME", "REGISTERED_VOTERS")


def places(precincts: DataFrame) -> DataFrame:
    """One row per code, region and province: ``_pk, REG_NAME, PRV_NAME``,
    ``_n`` rows of them in the precinct table, and COPIES, the rows of the
    code. Equal rows are counted before the rows of a code come together, so
    a window sees one row per region and province of a code. The steps keep
    the size estimate that the joins below go by."""
    p = precincts.where(F.col("CLUSTERED_PREC").isNotNull())
    p = p.groupBy(F.col("CLUSTERED_PREC").alias("_pk"), "REG_NAME", "PRV_NAME").agg(F.count(F.lit(1)).alias("_n"))
    copies = F.sum("_n").over(Window.partitionBy("_pk"))
    return p.withColumn("COPIES", copies).withColumn("MATCHED", F.lit(True))


VOTE_COLUMNS = ("CONTEST_CODE", "CANDIDATE_CODE", "MATCHED", "REG_NAME", "PRV_NAME", "COPIES")


def _placed(votes: DataFrame, p: DataFrame) -> DataFrame:
    """``votes`` (PRECINCT_CODE, ..., VOTES_AMOUNT) with the places of their
    codes; the votes count once for every precinct row of the place."""
    j = votes.join(p, F.col("PRECINCT_CODE") == F.col("_pk"), "left")
    amount = F.col("VOTES_AMOUNT") * F.coalesce("_n", F.lit(1))
    return j.select(*VOTE_COLUMNS[:2], F.coalesce("MATCHED", F.lit(False)).alias("MATCHED"), *VOTE_COLUMNS[3:], amount.alias("VOTES_AMOUNT"))


def summed_votes(e: Election, mapside: bool | None = None) -> DataFrame:
    """CONTEST_CODE, CANDIDATE_CODE, MATCHED, REG_NAME, PRV_NAME, COPIES,
    VOTES_AMOUNT: rows whose votes add up to those of the merged fact.

    Where Catalyst would broadcast the precinct side, that is the fact joined
    as it is, and the aggregate that follows reduces it in the same stage.
    Beyond (``mapside`` false), votes are summed by precinct, contest and
    candidate before the join: a precinct then has at most one row per
    contest and candidate, however many rows the fact has of it, so neither
    the sum nor the join has a hot key, and the fact is scanned once."""
    p = places(e.precincts)
    r = e.results.select("PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE", "VOTES_AMOUNT")
    if not (catalyst_broadcasts(p) if mapside is None else mapside):
        r = r.groupBy("PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE").agg(F.sum("VOTES_AMOUNT").alias("VOTES_AMOUNT"))
    return _placed(r, p)


def merged_votes(e: Election) -> DataFrame:
    """Narrow merged fact, row by row: (PRECINCT_CODE, CONTEST_CODE,
    CANDIDATE_CODE, VOTES_AMOUNT, MATCHED, REG_NAME, PRV_NAME)."""
    p = e.precincts.select(F.col("CLUSTERED_PREC").alias("_pk"), "REG_NAME", "PRV_NAME").withColumn("_m", F.lit(True))
    r = e.results.select("PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE", "VOTES_AMOUNT")
    j = join_dimension(r, p, "PRECINCT_CODE", "_pk", "left")
    matched = F.coalesce(F.col("_m"), F.lit(False)).alias("MATCHED")
    return j.select("PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE", "VOTES_AMOUNT", matched, "REG_NAME", "PRV_NAME")


def vote_base(e: Election) -> DataFrame:
    """Sum of VOTES_AMOUNT by ``VOTE_COLUMNS`` over the merged fact (null sums
    stay null here and are turned into 0 by the reports). COPIES, the number
    of precinct rows of the code, is one for all but duplicated codes."""
    return summed_votes(e).groupBy(*VOTE_COLUMNS).agg(F.sum("VOTES_AMOUNT").alias("VOTES_AMOUNT"))


BASES = ("votes", "precincts", "receptions")


def fact_bases(e: Election, wanted: Sequence[str] = BASES, mapside: bool | None = None) -> DataFrame:
    """All bases that need the fact, from one scan of it: one aggregate whose
    rows say in BASE (a place in ``BASES``) which base they belong to. Every
    fact row goes in once per base, inside the scan's stage, under that base's
    own key.

    votes       the sums of :func:`summed_votes`: by place (PLACED), or by
                precinct code where the precinct side is too large to broadcast
    precincts   per PRECINCT_CODE the smallest row by RESULT_ORDER, PACKED;
                rows with values too wide to pack stand as they are (FLAG)
    receptions  rows per RECEPTION_DATE and PRECINCT_CODE

    Read the bases back with the ``*_from`` functions. All measures have
    buffers of fixed width, so the aggregate is a hash aggregate."""
    r = e.results
    p = places(e.precincts)
    mapside = catalyst_broadcasts(p) if mapside is None else mapside
    joined = mapside and "votes" in wanted
    if joined:
        r = r.join(p, F.col("PRECINCT_CODE") == F.col("_pk"), "left")
    else:
        r = r.withColumn("_n", F.lit(1))
    r = r.withColumn("BASE", F.explode(F.array(*[F.lit(BASES.index(w)) for w in wanted])))
    votes, precincts, receptions = (F.col("BASE") == i for i in range(len(BASES)))
    fits, packed = pack(RESULT_ORDER)
    wide = precincts & ~fits

    # few key columns, since every row is hashed by all of them: the numbers
    # of the votes' key and of a wide row share N0 to N4, the texts T0 and T1
    numbers = [F.when(votes | wide, F.col(c)) for c in RESULT_ORDER[:2]]
    numbers += [F.when(wide, F.col(c)) for c in RESULT_ORDER[2:]]
    texts = [F.when(receptions, F.col("RECEPTION_DATE")), F.lit(None).cast("string")]
    code = F.col("PRECINCT_CODE")
    if joined:
        numbers[2] = F.when(votes, F.col("COPIES")).otherwise(numbers[2])
        texts = [F.when(votes, F.col("REG_NAME")).otherwise(texts[0]), F.when(votes, F.col("PRV_NAME"))]
        code = F.when(~votes, code)
    flag = wide | votes & F.coalesce("MATCHED", F.lit(False)) if joined else wide
    keys = [F.col("BASE"), flag.alias("FLAG"), code.alias("PRECINCT_CODE")]
    keys += [c.alias(f"N{i}") for i, c in enumerate(numbers)] + [c.alias(f"T{i}") for i, c in enumerate(texts)]
    # a code's places repeat its rows; receptions count each row for all of them
    copies = F.coalesce("_n", F.lit(1))
    amount = F.when(votes, F.col("VOTES_AMOUNT") * copies).when(receptions, copies)
    out = r.groupBy(*keys).agg(F.sum(amount).alias("AMOUNT"), F.min(F.when(precincts, packed)).alias("PACKED"))
    return out.withColumn("PLACED", F.lit(joined))


def _of(bases: DataFrame, name: str) -> DataFrame:
    return bases.where(F.col("BASE") == BASES.index(name))


def _placed_bases(bases: DataFrame) -> bool:
    """The votes of these bases are by place already (the same in all rows)."""
    row = bases.select("PLACED").first()
    return row is None or row.PLACED


def votes_from(e: Election, bases: DataFrame) -> DataFrame:
    """:func:`vote_base` from stored :func:`fact_bases`."""
    v = _of(bases, "votes").withColumnsRenamed({"N0": "CONTEST_CODE", "N1": "CANDIDATE_CODE", "AMOUNT": "VOTES_AMOUNT"})
    if _placed_bases(bases):
        v = v.withColumnsRenamed({"FLAG": "MATCHED", "T0": "REG_NAME", "T1": "PRV_NAME", "N2": "COPIES"})
        return v.select(*VOTE_COLUMNS, "VOTES_AMOUNT")
    placed = _placed(v.select("PRECINCT_CODE", *VOTE_COLUMNS[:2], "VOTES_AMOUNT"), places(e.precincts))
    return placed.groupBy(*VOTE_COLUMNS).agg(F.sum("VOTES_AMOUNT").alias("VOTES_AMOUNT"))


def _unpacked(packed: DataFrame, wide: DataFrame | None) -> DataFrame:
    """PRECINCT_CODE and the columns of RESULT_ORDER: the smaller one of the
    packed row and the wide rows of a precinct. Without wide rows (``wide``
    None) every precinct has its one packed row."""
    rows = packed.select("PRECINCT_CODE", *unpack(F.col("PACKED"), RESULT_ORDER))
    if wide is None:
        return rows
    wide = wide.select("PRECINCT_CODE", *[F.col(f"N{i}").alias(c) for i, c in enumerate(RESULT_ORDER)])
    return first_row_per_key(rows.unionByName(wide), "PRECINCT_CODE", RESULT_ORDER)


def precincts_from(e: Election, bases: DataFrame) -> DataFrame:
    """:func:`precinct_base` from stored :func:`fact_bases` (they are looked
    at for wide rows first)."""
    b = _of(bases, "precincts")
    wide = b.where("FLAG")
    return _with_places(e, _unpacked(b.where("not FLAG"), None if wide.isEmpty() else wide))


def receptions_from(e: Election, bases: DataFrame) -> DataFrame:
    """RECEPTION_DATE, PRECINCT_CODE and VCM_COUNT, the merged rows, from
    stored :func:`fact_bases`."""
    b = _of(bases, "receptions").select(F.col("T0").alias("RECEPTION_DATE"), "PRECINCT_CODE", F.col("AMOUNT").alias("_n"))
    return b.withColumnRenamed("_n", "VCM_COUNT") if _placed_bases(bases) else _merged_rows(e, b)


def _merged_rows(e: Election, pairs: DataFrame) -> DataFrame:
    mult = e.precincts.groupBy(F.col("CLUSTERED_PREC").alias("_pk")).agg(F.count(F.lit(1)).alias("_k"))
    j = pairs.join(mult, F.col("PRECINCT_CODE") == F.col("_pk"), "left")
    return j.select("RECEPTION_DATE", "PRECINCT_CODE", (F.col("_n") * F.coalesce(F.col("_k"), F.lit(1))).alias("VCM_COUNT"))


def precinct_base(e: Election) -> DataFrame:
    """One row per PRECINCT_CODE of the merged fact.

    Columns: PRECINCT_CODE, PRV_NAME, REG_NAME, UNDERVOTE, OVERVOTE,
    NUMBER_VOTERS, REGISTERED_VOTERS. The representative is the merged row
    smallest by RESULT_ORDER then PRECINCT_ORDER. Computed as the smallest
    raw result row per precinct (a hash aggregate over packed rows on the
    fact, then a choice among the few rows left of a precinct) joined to
    the smallest precinct row per CLUSTERED_PREC; because every result row
    of a precinct meets the same precinct rows, this equals the lexicographic
    minimum over the merged rows, without joining the whole fact first.
    """
    fits, packed = pack(RESULT_ORDER)
    wide = [F.when(~fits, F.col(c)).alias(f"W_{c}") for c in RESULT_ORDER]
    rows = e.results.groupBy("PRECINCT_CODE", (~fits).alias("WIDE"), *wide).agg(F.min(packed).alias("PACKED"))
    packed_row = F.when(~F.col("WIDE"), F.struct(*unpack(F.col("PACKED"), RESULT_ORDER)))
    row = F.coalesce(packed_row, F.struct(*[F.col(f"W_{c}").alias(c) for c in RESULT_ORDER]))
    rows = rows.select("PRECINCT_CODE", row.alias("_r")).select("PRECINCT_CODE", "_r.*")
    return _with_places(e, first_row_per_key(rows, "PRECINCT_CODE", RESULT_ORDER))


def _with_places(e: Election, rep: DataFrame) -> DataFrame:
    pre = first_row_per_key(
        e.precincts.select("CLUSTERED_PREC", *PRECINCT_ORDER), "CLUSTERED_PREC", PRECINCT_ORDER
    )
    j = rep.join(pre, F.col("PRECINCT_CODE") == F.col("CLUSTERED_PREC"), "left")
    return j.select(
        "PRECINCT_CODE",
        "PRV_NAME",
        "REG_NAME",
        "UNDERVOTE",
        "OVERVOTE",
        "NUMBER_VOTERS",
        "REGISTERED_VOTERS",
    )


def reception_pairs(e: Election) -> DataFrame:
    """Result rows per (RECEPTION_DATE, PRECINCT_CODE): one row per machine
    and reception text, computed with a partial aggregate on the fact. Both
    reception bases derive from it, so the fact is read once for them and
    the timestamp text is parsed once per pair, not once per result row."""
    return e.results.groupBy("RECEPTION_DATE", "PRECINCT_CODE").agg(F.count(F.lit(1)).alias("_n"))


def reception_counts(e: Election, pairs: DataFrame | None = None) -> DataFrame:
    """Rows of the merged fact per RECEPTION_DATE text (null kept as a group).

    The merged fact repeats a result row once per matching precinct row.
    Instead of joining the whole fact, rows are first counted per
    (RECEPTION_DATE, PRECINCT_CODE) with a partial aggregate, then scaled by
    the number of precinct rows sharing that code (1 when unmatched).
    ``pairs``: the rows of :func:`receptions_from`.
    """
    per = _merged_rows(e, reception_pairs(e)) if pairs is None else pairs
    return per.groupBy("RECEPTION_DATE").agg(F.sum("VCM_COUNT").cast("bigint").alias("VCM_COUNT"))


def reception_times(e: Election, pairs: DataFrame | None = None) -> DataFrame:
    """Earliest parsed reception time per precinct (PRECINCT_CODE, RECEPTION_TS).

    Text that does not match the documented layout parses to null.
    """
    from canvass.schema import RECEPTION_FORMAT

    per = reception_pairs(e) if pairs is None else pairs
    ts = F.try_to_timestamp(F.col("RECEPTION_DATE"), F.lit(RECEPTION_FORMAT))
    return per.groupBy("PRECINCT_CODE").agg(F.min(ts).alias("RECEPTION_TS"))
