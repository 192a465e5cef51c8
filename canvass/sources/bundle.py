"""The ``Election`` bundle: five lazy DataFrames, plus the denormalised fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Election:
    """Five election tables as lazy DataFrames (nothing is collected).

    ``precincts`` holds the five load-time columns (VCM_ID, REG_NAME,
    PRV_NAME, CLUSTERED_PREC, REGISTERED_VOTERS), ``contests`` only
    CONTEST_CODE; ``results`` is the raw fact table (ten columns).
    """

    results: DataFrame
    candidates: DataFrame
    precincts: DataFrame
    contests: DataFrame
    parties: DataFrame

    @property
    def merged(self) -> DataFrame:
        return merged_results(self)

    def register_views(self, prefix: str = "") -> None:
        """Temporary views ``{prefix}results``, ``candidates``, ``precincts``,
        ``contests``, ``parties`` and ``merged_results`` for ``spark.sql``."""
        for name in ("results", "candidates", "precincts", "contests", "parties"):
            getattr(self, name).createOrReplaceTempView(f"{prefix}{name}")
        self.merged.createOrReplaceTempView(f"{prefix}merged_results")


def merged_results(e: Election) -> DataFrame:
    """results LEFT JOIN precincts ON PRECINCT_CODE = CLUSTERED_PREC.

    Adds REG_NAME, PRV_NAME, REGISTERED_VOTERS; the right key is dropped.
    Unmatched results keep null precinct attributes; a duplicated
    CLUSTERED_PREC multiplies its result rows, a null key never matches.
    The precinct side is broadcast after a size check; beyond it the join
    shuffles with hot precinct codes salted (see ``join_dimension``).
    """
    from canvass.operators.joins import join_dimension

    p = e.precincts.select("CLUSTERED_PREC", "REG_NAME", "PRV_NAME", "REGISTERED_VOTERS")
    return join_dimension(e.results, p, "PRECINCT_CODE", "CLUSTERED_PREC", "left").drop("CLUSTERED_PREC")
