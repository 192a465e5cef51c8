"""Explicit schemas of the five election tables and fixed constants."""

from __future__ import annotations

from pyspark.sql import types as T

# National contest codes (PRESIDENT, VICE_PRESIDENT, SENATOR,
# PARTY_LIST). Every other contest code is a local contest.
NATIONAL_CONTESTS: tuple[int, ...] = (199000, 299000, 399000, 1199000)

# Fixed value: layout of RECEPTION_DATE, e.g. "05/09/2022 - 07:08:48 PM".
RECEPTION_FORMAT = "MM/dd/yyyy - hh:mm:ss a"

_L = T.LongType()
_S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CANDIDATES = _struct(("CONTEST_CODE", _L), ("CANDIDATE_CODE", _L), ("CANDIDATE_NAME", _S))
CONTESTS = _struct(("CONTEST_CODE", _L), ("CONTEST_NAME", _S))
PARTIES = _struct(("PARTIES_CODE", _L), ("PARTIES_NAME", _S), ("PARTIES_ALIAS", _S))
PRECINCTS = _struct(
    ("VCM_ID", _L),
    ("REG_NAME", _S),
    ("PRV_NAME", _S),
    ("MUN_NAME", _S),
    ("BRGY_NAME", _S),
    ("POLLPLACE", _S),
    ("CLUSTERED_PREC", _L),
    ("REGISTERED_VOTERS", _L),
)
RESULTS = _struct(
    ("PRECINCT_CODE", _L),
    ("CONTEST_CODE", _L),
    ("CANDIDATE_CODE", _L),
    ("PARTY_CODE", _L),
    ("VOTES_AMOUNT", _L),
    ("TOTALIZATION_ORDER", _L),
    ("NUMBER_VOTERS", _L),
    ("UNDERVOTE", _L),
    ("OVERVOTE", _L),
    ("RECEPTION_DATE", _S),
)

TABLES: dict[str, T.StructType] = {
    "candidates": CANDIDATES,
    "contests": CONTESTS,
    "parties": PARTIES,
    "precincts": PRECINCTS,
    "results": RESULTS,
}

# Columns kept at load time (the rest are pruned before any plan sees them).
PRECINCT_COLUMNS = ("VCM_ID", "REG_NAME", "PRV_NAME", "CLUSTERED_PREC", "REGISTERED_VOTERS")
CONTEST_COLUMNS = ("CONTEST_CODE",)
