"""One deterministic row per key ("keep any row", made reproducible)."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_row_per_key(df: DataFrame, key: str, order: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Per ``key``, the row that is smallest by ``order`` then ``carry``.

    Ascending, nulls first, field by field. Written as ``min(struct(...))``:
    an aggregate with a map-side partial step, so a key holding a third of
    all rows is reduced inside every input task before the shuffle and no
    single task ever sees the whole group (a window would). The output has
    ``key`` followed by the ``order`` and ``carry`` columns.
    """
    fields = [*order, *[c for c in carry if c not in order]]
    m = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_first"))
    return m.select(key, *[F.col("_first")[f].alias(f) for f in fields])


# Widths in bits of the packed columns: two longs of 62 and 60 bits.
HIGH, LOW = (28, 34), (20, 20, 20)
_SHIFT = sum(LOW)


def _long(columns: Sequence[Column], bits: Sequence[int]) -> Column:
    """Columns side by side in one long, null as 0 and v as v + 1."""
    out = F.lit(0).cast("bigint")
    for c, b in zip(columns, bits):
        out = F.shiftleft(out, b).bitwiseOR(F.coalesce(c + 1, F.lit(0)).cast("bigint"))
    return out


def pack(order: Sequence[str]) -> tuple[Column, Column]:
    """(``fits``, ``packed``) for five integer columns: ``packed`` is a
    decimal(38,0) that sorts as the columns do, nulls first, and ``fits``
    says whether a row's values are within the widths (others need another
    way; ``packed`` is null for them). A minimum of a decimal has a buffer of
    fixed width, so it is a hash aggregate, which a minimum of structs is not."""
    columns, widths = [F.col(c) for c in order], [*HIGH, *LOW]
    inside = [c.isNull() | c.between(0, (1 << b) - 2) for c, b in zip(columns, widths)]
    fits = reduce(lambda a, b: a & b, inside)
    high, low = _long(columns[: len(HIGH)], HIGH), _long(columns[len(HIGH) :], LOW)
    wide = high.cast("decimal(19,0)") * F.lit(Decimal(1 << _SHIFT)).cast("decimal(19,0)")
    packed = wide.cast("decimal(38,0)") + low.cast("decimal(19,0)")
    return fits, F.when(fits, packed.cast("decimal(38,0)"))


def unpack(packed: Column, order: Sequence[str]) -> list[Column]:
    """The columns of :func:`pack` again, by name."""
    unit = F.lit(Decimal(1 << _SHIFT)).cast("decimal(19,0)")
    low = F.pmod(packed, unit).cast("bigint")
    high = ((packed - F.pmod(packed, unit)) / unit).cast("decimal(38,0)").cast("bigint")
    out = []
    for c, widths, names in ((high, HIGH, order[: len(HIGH)]), (low, LOW, order[len(HIGH) :])):
        right = sum(widths)
        for name, b in zip(names, widths):
            right -= b
            v = F.shiftright(c, right).bitwiseAND(F.lit((1 << b) - 1))
            out.append(F.when(v > 0, v - 1).alias(name))
    return out
