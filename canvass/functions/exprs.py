"""Column helpers with explicit null / NaN / division-by-zero rules.

Spark 4 runs with ANSI mode on, so a bare ``/`` raises on a zero divisor
(doubles included). The reports need IEEE results instead (``n/0`` is
+-inf, ``0/0`` is NaN, a null operand gives null), so every division on a
possibly-zero denominator goes through :func:`ratio`. All helpers are plain
Catalyst expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(n: ColumnOrName, d: ColumnOrName) -> Column:
    """IEEE division ``n / d`` as double.

    null operand -> null; ``d != 0`` -> n/d; ``0/0`` -> NaN; ``n/0`` ->
    +inf or -inf by the sign of n. The null test comes first: ``d != 0`` is
    null for a null ``d`` and would otherwise fall through.
    """
    n, d = _c(n).cast("double"), _c(d).cast("double")
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when(d != 0, n / d)
        .when(n.isNaN() | (n == 0), F.lit(float("nan")))
        .when(n > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )


def pct_guarded(n: ColumnOrName, d: ColumnOrName) -> Column:
    """``100 * n / d`` when ``d > 0`` else 0.0 (a null ``d`` also gives 0.0)."""
    n, d = _c(n), _c(d)
    return F.when(d > 0, (F.lit(100) * n).cast("double") / d.cast("double")).otherwise(F.lit(0.0))


def nan_to_zero(c: ColumnOrName) -> Column:
    """Replace NaN by 0.0; +-inf and null pass through unchanged."""
    return F.nanvl(_c(c), F.lit(0.0))


def is_national(c: ColumnOrName = "CONTEST_CODE") -> Column:
    """CONTEST_CODE is one of the national contests. Null stays null, so a
    null code passes neither this filter nor its negation."""
    from canvass.schema import NATIONAL_CONTESTS

    return _c(c).isin(*NATIONAL_CONTESTS)


def json_number(c: ColumnOrName) -> Column:
    """A double as a JSON-safe value: NaN and +-inf become null."""
    c = _c(c)
    return F.when(is_finite(c), c)


def sum0(c: ColumnOrName) -> Column:
    """Sum that is 0 (not null) for an empty or all-null group, as bigint."""
    c = _c(c)
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def n_unique(c: ColumnOrName) -> Column:
    """Exact distinct count that counts null as one more value."""
    c = _c(c)
    return (
        F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
    ).cast("bigint")


def is_finite(c: ColumnOrName) -> Column:
    c = _c(c)
    return c.isNotNull() & ~c.isNaN() & (F.abs(c) != F.lit(float("inf")))


def pearson(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson r as an aggregate, in full precision.

    Feed only rows where both inputs are non-null (``stddev_pop`` on one
    column would otherwise see rows the covariance skips). Degenerate input
    (no rows, one row, zero variance) gives null instead of raising; NaN or
    inf inputs give NaN. Composed of partial-aggregatable built-ins, so it
    runs map-side on every partition and merges once.
    """
    x, y = _c(x), _c(y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
