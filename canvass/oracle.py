"""Reference SQL (DuckDB dialect) for every registered query.

Used only by the correctness check: each statement spells out the mapping
from the driver's test tables to the election tables as CTEs, then states
the report in plain SQL (windows / row_number where the Spark plan uses
skew-safe aggregates instead). Column names and types match the Spark
output. Sums are cast to BIGINT (DuckDB sums to HUGEINT).
"""

from __future__ import annotations

NATIONAL = "(199000, 299000, 399000, 1199000)"

DRIVER_TABLES = f"""
precincts_all AS (
  SELECT CAST(c.c_custkey + 10000000 AS BIGINT) AS VCM_ID,
         r.r_name AS REG_NAME, n.n_name AS PRV_NAME,
         c.c_mktsegment AS MUN_NAME, c.c_name AS BRGY_NAME,
         concat('SCHOOL ', CAST(c.c_custkey AS VARCHAR)) AS POLLPLACE,
         CAST(CASE WHEN c.c_custkey % 100 = 52 THEN c.c_custkey - 1 ELSE c.c_custkey END AS BIGINT) AS CLUSTERED_PREC,
         CAST(CASE WHEN c.c_custkey % 97 = 0 THEN 0 ELSE 600 + c.c_custkey % 300 END AS BIGINT) AS REGISTERED_VOTERS
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE c.c_custkey % 50 <> 13
),
precincts AS (
  SELECT VCM_ID, REG_NAME, PRV_NAME, CLUSTERED_PREC, REGISTERED_VOTERS FROM precincts_all
),
results_src AS (
  SELECT o.o_custkey AS k, l.l_linenumber AS line, l.l_suppkey AS supp, l.l_quantity AS qty,
         CAST(CASE l.l_linenumber WHEN 1 THEN 199000 WHEN 2 THEN 299000 WHEN 3 THEN 399000
              WHEN 4 THEN 1199000 WHEN 5 THEN 2000000 + o.o_custkey % 25
              ELSE 3000000 + o.o_custkey % 25 END AS BIGINT) AS contest
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_custkey % 10 <> 7
),
results AS (
  SELECT CAST(k AS BIGINT) AS PRECINCT_CODE,
         contest AS CONTEST_CODE,
         CAST(contest * 100 + supp % 10 AS BIGINT) AS CANDIDATE_CODE,
         CAST(supp % 7 AS BIGINT) AS PARTY_CODE,
         CAST(qty AS BIGINT) AS VOTES_AMOUNT,
         CAST(line AS BIGINT) AS TOTALIZATION_ORDER,
         CAST(CASE WHEN k % 194 = 0 THEN 0 WHEN k % 97 = 0 THEN 5 ELSE 300 + (k * 7) % 300 END AS BIGINT)
           AS NUMBER_VOTERS,
         CAST((k * 3 + line) % 40 AS BIGINT) AS UNDERVOTE,
         CAST((k * 5 + line) % 10 AS BIGINT) AS OVERVOTE,
         concat(CASE WHEN k % 2 = 0 THEN '05/09/2022' ELSE '05/10/2022' END, ' - ',
                lpad(CAST(1 + k % 12 AS VARCHAR), 2, '0'), ':',
                lpad(CAST(k % 60 AS VARCHAR), 2, '0'), ':00 ',
                CASE WHEN k % 3 = 0 THEN 'AM' ELSE 'PM' END) AS RECEPTION_DATE
  FROM results_src
),
candidates AS (
  SELECT CONTEST_CODE, CANDIDATE_CODE,
         concat('CANDIDATE ', CAST(CANDIDATE_CODE AS VARCHAR)) AS CANDIDATE_NAME
  FROM (SELECT DISTINCT CONTEST_CODE, CANDIDATE_CODE FROM results) d
  WHERE NOT (CONTEST_CODE NOT IN {NATIONAL} AND CANDIDATE_CODE % 10 = 9)
),
contests AS (
  SELECT CONTEST_CODE, concat('CONTEST ', CAST(CONTEST_CODE AS VARCHAR)) AS CONTEST_NAME
  FROM (SELECT DISTINCT CONTEST_CODE FROM results) d
),
parties AS (
  SELECT PARTIES_CODE, concat('PARTY ', CAST(PARTIES_CODE AS VARCHAR)) AS PARTIES_NAME,
         concat('P', CAST(PARTIES_CODE AS VARCHAR)) AS PARTIES_ALIAS
  FROM (SELECT DISTINCT CAST(l_suppkey % 7 AS BIGINT) AS PARTIES_CODE FROM lineitem) d
)"""

DERIVED = """merged AS (
  SELECT r.*, p.REG_NAME, p.PRV_NAME, p.REGISTERED_VOTERS, p.CLUSTERED_PREC IS NOT NULL AS MATCHED
  FROM results r LEFT JOIN precincts p ON r.PRECINCT_CODE = p.CLUSTERED_PREC
),
pb AS (
  SELECT PRECINCT_CODE, PRV_NAME, REG_NAME, UNDERVOTE, OVERVOTE, NUMBER_VOTERS, REGISTERED_VOTERS
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY PRECINCT_CODE
      ORDER BY CONTEST_CODE NULLS FIRST, CANDIDATE_CODE NULLS FIRST, UNDERVOTE NULLS FIRST,
               OVERVOTE NULLS FIRST, NUMBER_VOTERS NULLS FIRST, PRV_NAME NULLS FIRST,
               REG_NAME NULLS FIRST, REGISTERED_VOTERS NULLS FIRST) AS rn
    FROM merged) t
  WHERE rn = 1
)"""

ADAPTER = DRIVER_TABLES + ",\n" + DERIVED



def over_tables(sql: str, tables: str) -> str:
    """The same statement over other input tables: ``tables`` must define
    the CTEs results, precincts (5 load-time columns), candidates, contests
    and parties; it replaces the mapping from the driver tables."""
    return sql.replace(DRIVER_TABLES, tables, 1)


def q(select: str, extra: str = "") -> str:
    ctes = ADAPTER + (",\n" + extra if extra else "")
    return f"WITH {ctes}\n{select}"


def _s(col: str, alias: str | None = None) -> str:
    return f"CAST(coalesce(sum({col}), 0) AS BIGINT) AS {alias or col}"


NAT_PRV = f"""nat_prv AS (
  SELECT CONTEST_CODE, PRV_NAME, CANDIDATE_CODE, {_s('VOTES_AMOUNT')}
  FROM merged WHERE CONTEST_CODE IN {NATIONAL} GROUP BY 1, 2, 3)"""

TF = """tf AS (
  SELECT p.CLUSTERED_PREC, p.PRV_NAME, p.REGISTERED_VOTERS,
         CASE WHEN p.CLUSTERED_PREC IS NULL THEN NULL
              ELSE EXISTS (SELECT 1 FROM results r WHERE r.PRECINCT_CODE = p.CLUSTERED_PREC) END AS TRANSMITTED
  FROM precincts p)"""

TBP = f"""{TF},
tbp0 AS (
  SELECT PRV_NAME,
         count(CLUSTERED_PREC) AS total_clustered_precincts,
         count(CASE WHEN TRANSMITTED THEN CLUSTERED_PREC END) AS vcm_transmitted,
         count(CASE WHEN NOT TRANSMITTED THEN CLUSTERED_PREC END) AS vcm_not_transmitted,
         {_s('CASE WHEN NOT TRANSMITTED THEN REGISTERED_VOTERS END', 'number_of_voters_not_transmitted')}
  FROM tf GROUP BY PRV_NAME),
tbp AS (
  SELECT *, CASE WHEN total_clustered_precincts > 0
                 THEN (100 * vcm_transmitted) / total_clustered_precincts
                 ELSE CAST(0 AS DOUBLE) END AS vcm_transmitted_percentile
  FROM tbp0)"""

VSP = f"""vsp0 AS (
  SELECT PRV_NAME, {_s('UNDERVOTE', 'total_undervotes')}, {_s('OVERVOTE', 'total_overvotes')},
         {_s('NUMBER_VOTERS', 'total_voters')}, {_s('REGISTERED_VOTERS', 'total_registered_voters')}
  FROM pb GROUP BY PRV_NAME),
vsp AS (
  SELECT *, CASE WHEN total_registered_voters > 0
                 THEN (100 * total_voters) / total_registered_voters
                 ELSE CAST(0 AS DOUBLE) END AS voter_turnout
  FROM vsp0)"""

# Output field names (sorted), as in the Spark reports.
MAP_FIELDS = (
    "number_of_voters_not_transmitted",
    "total_clustered_precincts",
    "total_overvotes",
    "total_registered_voters",
    "total_undervotes",
    "total_voters",
    "vcm_not_transmitted",
    "vcm_transmitted",
    "vcm_transmitted_percentile",
    "voter_turnout",
)
_MAP_INT = set(MAP_FIELDS) - {"vcm_transmitted_percentile", "voter_turnout"}

_MAP_FROM_TRANSMISSION = {
    "number_of_voters_not_transmitted",
    "total_clustered_precincts",
    "vcm_not_transmitted",
    "vcm_transmitted",
    "vcm_transmitted_percentile",
}


def _map_field(f: str) -> str:
    side = "t" if f in _MAP_FROM_TRANSMISSION else "v"
    zero = "0" if f in _MAP_INT else "CAST(0 AS DOUBLE)"
    return f"coalesce({side}.{f}, {zero}) AS {f}"


MAP = f"""{TBP},
{VSP},
ms AS (
  SELECT coalesce(t.PRV_NAME, v.PRV_NAME) AS PRV_NAME,
         {', '.join(_map_field(f) for f in MAP_FIELDS)}
  FROM tbp t FULL OUTER JOIN vsp v ON t.PRV_NAME = v.PRV_NAME)"""

VOTER_STATS = """vs AS (
  SELECT CAST(coalesce(sum(OVERVOTE), 0) AS BIGINT) AS total_number_of_overvotes,
         (SELECT CAST(count(DISTINCT CLUSTERED_PREC)
                      + coalesce(max(CASE WHEN CLUSTERED_PREC IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)
          FROM precincts) AS total_number_of_precincts,
         CAST(coalesce(sum(REGISTERED_VOTERS), 0) AS BIGINT) AS total_number_of_registered_voters,
         count(*) AS total_number_of_reporting_precincts,
         CAST(coalesce(sum(UNDERVOTE), 0) AS BIGINT) AS total_number_of_undervotes,
         CAST(coalesce(sum(NUMBER_VOTERS), 0) AS BIGINT) AS total_number_of_voters
  FROM pb)"""

TURNOUT = ("CASE WHEN isnan(NUMBER_VOTERS / REGISTERED_VOTERS * 100) THEN CAST(0 AS DOUBLE) "
           "ELSE NUMBER_VOTERS / REGISTERED_VOTERS * 100 END")
SPOILED = ("(coalesce(UNDERVOTE, 0) + coalesce(OVERVOTE, 0)) / coalesce(NUMBER_VOTERS, 0) * 100")

JTS = f"""jts AS (
  SELECT PRECINCT_CODE, {TURNOUT} AS VOTER_TURNOUT, {SPOILED} AS SPOILED_PERCENTAGE
  FROM pb WHERE PRECINCT_CODE IS NOT NULL)"""

RT = """rt AS (
  SELECT PRECINCT_CODE, min(try_strptime(RECEPTION_DATE, '%m/%d/%Y - %I:%M:%S %p')) AS ts
  FROM results GROUP BY PRECINCT_CODE)"""

TALLY_NATIONAL = q(
    """SELECT n.CONTEST_CODE, c.CANDIDATE_NAME, n.VOTES_AMOUNT,
       (n.VOTES_AMOUNT * 100) / (SELECT t FROM tot) AS PERCENTAGE
FROM nat n JOIN candidates c ON n.CANDIDATE_CODE = c.CANDIDATE_CODE""",
    f"""nat AS (
  SELECT CONTEST_CODE, CANDIDATE_CODE, {_s('VOTES_AMOUNT')}
  FROM merged WHERE CONTEST_CODE IN {NATIONAL} GROUP BY 1, 2),
tot AS (SELECT CAST(coalesce(sum(NUMBER_VOTERS), 0) AS BIGINT) AS t FROM pb)""",
)

TALLY_LOCAL = q(
    """SELECT l.CONTEST_CODE, c.CANDIDATE_NAME, l.VOTES_AMOUNT, (l.VOTES_AMOUNT * 100) / l.cv AS PERCENTAGE
FROM loc2 l JOIN candidates c ON l.CANDIDATE_CODE = c.CANDIDATE_CODE""",
    f"""loc AS (
  SELECT CONTEST_CODE, CANDIDATE_CODE, {_s('VOTES_AMOUNT')}
  FROM merged WHERE CONTEST_CODE NOT IN {NATIONAL} GROUP BY 1, 2),
loc2 AS (SELECT *, CAST(sum(VOTES_AMOUNT) OVER (PARTITION BY CONTEST_CODE) AS BIGINT) AS cv FROM loc)""",
)

TALLY_NATIONAL_PROVINCE_CTE = f"""{NAT_PRV},
den AS (SELECT PRV_NAME, {_s('NUMBER_VOTERS', 'nv')} FROM pb GROUP BY PRV_NAME),
tnp AS (
  SELECT n.CONTEST_CODE, n.PRV_NAME, c.CANDIDATE_NAME, n.VOTES_AMOUNT,
         (n.VOTES_AMOUNT * 100) / d.nv AS PERCENTAGE
  FROM nat_prv n JOIN den d ON n.PRV_NAME = d.PRV_NAME
  JOIN candidates c ON n.CANDIDATE_CODE = c.CANDIDATE_CODE)"""

TALLY_NATIONAL_PROVINCE = q("SELECT * FROM tnp", TALLY_NATIONAL_PROVINCE_CTE)

LEADING = q(
    """SELECT l.CONTEST_CODE, l.PRV_NAME, c.CANDIDATE_NAME, l.VOTES_AMOUNT
FROM lead l JOIN candidates c ON l.CANDIDATE_CODE = c.CANDIDATE_CODE WHERE l.rn = 1""",
    f"""{NAT_PRV},
lead AS (
  SELECT *, row_number() OVER (PARTITION BY CONTEST_CODE, PRV_NAME
                               ORDER BY VOTES_AMOUNT DESC, CANDIDATE_CODE ASC NULLS LAST) AS rn
  FROM nat_prv)""",
)



def _by_region(source: str) -> str:
    """``source``: merged (joined to the precincts a second time) or results."""
    return q(
        """SELECT REG_NAME, CANDIDATE_CODE, CANDIDATE_NAME, VOTES_AMOUNT,
       CASE WHEN isnan(VOTES_AMOUNT / rv * 100) THEN CAST(0 AS DOUBLE) ELSE VOTES_AMOUNT / rv * 100 END
         AS PERCENTAGE
FROM g2""",
        f"""g AS (
  SELECT p.REG_NAME, c.CANDIDATE_CODE, c.CANDIDATE_NAME, {_s('r.VOTES_AMOUNT', 'VOTES_AMOUNT')}
  FROM {source} r
  JOIN precincts p ON r.PRECINCT_CODE = p.CLUSTERED_PREC
  JOIN candidates c ON r.CANDIDATE_CODE = c.CANDIDATE_CODE
  WHERE r.CONTEST_CODE IN {NATIONAL}
  GROUP BY 1, 2, 3),
g2 AS (SELECT *, CAST(sum(VOTES_AMOUNT) OVER (PARTITION BY REG_NAME) AS BIGINT) AS rv FROM g)""",
    )


CANDIDATE_BY_REGION = _by_region("merged")

MAP_STATS = q(f"SELECT PRV_NAME, {', '.join(MAP_FIELDS)} FROM ms", MAP)
MAP_STATS_JSON = q(
    "SELECT PRV_NAME, CAST(to_json(struct_pack("
    + ", ".join(f"{f} := {f}" for f in MAP_FIELDS)
    + ")) AS VARCHAR) AS STATS_JSON FROM ms WHERE PRV_NAME IS NOT NULL",
    MAP,
)
VOTER_STATS_FIELDS = (
    "total_number_of_overvotes",
    "total_number_of_precincts",
    "total_number_of_registered_voters",
    "total_number_of_reporting_precincts",
    "total_number_of_undervotes",
    "total_number_of_voters",
)

VCM_RECEIVED = q(
    """SELECT RECEPTION_DATE,
       CAST(sum(VCM_COUNT) OVER (ORDER BY RECEPTION_DATE ASC NULLS FIRST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS VCM_RECEIVED
FROM rc""",
    "rc AS (SELECT RECEPTION_DATE, count(*) AS VCM_COUNT FROM merged GROUP BY RECEPTION_DATE)",
)

RECEPTION_BY_MINUTE = q(
    """SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS RECEPTION_MINUTE, count(*) AS VCM_COUNT
FROM rt WHERE ts IS NOT NULL GROUP BY 1""",
    RT,
)

SPOILED_BALLOTS = q(
    f"""SELECT PRV_NAME, PRECINCT_CODE, coalesce(UNDERVOTE, 0) AS UNDERVOTE, coalesce(OVERVOTE, 0) AS OVERVOTE,
       coalesce(NUMBER_VOTERS, 0) AS NUMBER_VOTERS,
       coalesce(UNDERVOTE, 0) + coalesce(OVERVOTE, 0) AS TOTAL_SPOILED,
       {SPOILED} AS SPOILED_PERCENTAGE
FROM pb"""
)

VOTES_BY_CONTEST_CANDIDATE = q(
    f"SELECT CONTEST_CODE, CANDIDATE_CODE, {_s('VOTES_AMOUNT')} FROM merged GROUP BY 1, 2"
)

NATIONAL_AND_LOCAL = q(
    """SELECT n.CONTEST_CODE, c.CANDIDATE_NAME, n.VOTES_AMOUNT, (n.VOTES_AMOUNT * 100) / (SELECT t FROM tot) AS PERCENTAGE
FROM nat n JOIN candidates c ON n.CANDIDATE_CODE = c.CANDIDATE_CODE
UNION ALL
SELECT l.CONTEST_CODE, c.CANDIDATE_NAME, l.VOTES_AMOUNT, (l.VOTES_AMOUNT * 100) / l.cv AS PERCENTAGE
FROM loc2 l JOIN candidates c ON l.CANDIDATE_CODE = c.CANDIDATE_CODE""",
    f"""nat AS (
  SELECT CONTEST_CODE, CANDIDATE_CODE, {_s('VOTES_AMOUNT')}
  FROM merged WHERE CONTEST_CODE IN {NATIONAL} GROUP BY 1, 2),
tot AS (SELECT CAST(coalesce(sum(NUMBER_VOTERS), 0) AS BIGINT) AS t FROM pb),
loc AS (
  SELECT CONTEST_CODE, CANDIDATE_CODE, {_s('VOTES_AMOUNT')}
  FROM merged WHERE CONTEST_CODE NOT IN {NATIONAL} GROUP BY 1, 2),
loc2 AS (SELECT *, CAST(sum(VOTES_AMOUNT) OVER (PARTITION BY CONTEST_CODE) AS BIGINT) AS cv FROM loc)""",
)


CORRELATION_FINITE = q(
    "SELECT round(corr(SPOILED_PERCENTAGE, VOTER_TURNOUT), 9) AS correlation FROM jts "
    "WHERE isfinite(VOTER_TURNOUT) AND isfinite(SPOILED_PERCENTAGE)",
    JTS,
)


# Rows of the job's outputs, as (output, key of the report's SQL, KEY, NAME,
# AMOUNT, SHARE).
JOB_OUTPUTS = (
    ("contest", "sink_by_contest", "CONTEST_CODE", "CANDIDATE_NAME", "VOTES_AMOUNT", "PERCENTAGE"),
    ("province", "sink_by_province", "concat_ws('_', PRV_KEY, CONTEST_CODE)", "CANDIDATE_NAME", "VOTES_AMOUNT", "PERCENTAGE"),
    ("map", "sink_map_leaders", "concat_ws('_', PRV_NAME, CONTEST_CODE)", "CANDIDATE_NAME", "VOTES_AMOUNT", "NULL"),
    ("region", "candidate_by_region", "REG_NAME", "CANDIDATE_NAME", "VOTES_AMOUNT", "PERCENTAGE"),
    ("received", "vcm_received", "RECEPTION_DATE", "NULL", "VCM_RECEIVED", "NULL"),
    ("rate", "reception_rate_text", "concat_ws('|', RECEPTION_DATE_ONLY, RECEPTION_HOUR, RECEPTION_MINUTE)", "NULL", "VCM_COUNT", "NULL"),
    ("turnout", "turnout_by_precinct", "PRECINCT_CODE", "NULL", "NUMBER_VOTERS", "VOTER_TURNOUT"),
    ("spoiled", "spoiled_ballots", "PRECINCT_CODE", "PRV_NAME", "TOTAL_SPOILED", "SPOILED_PERCENTAGE"),
    ("map_stats", "map_stats", "PRV_NAME", "NULL", "total_voters", "voter_turnout"),
    *(("voter_stats", "voter_stats", f"'{f}'", "NULL", f, "NULL") for f in VOTER_STATS_FIELDS),
)


def _job_outputs(sql: dict[str, str]) -> str:
    parts = [
        f"SELECT '{output}' AS OUTPUT, CAST({key} AS VARCHAR) AS KEY, CAST({name} AS VARCHAR) AS NAME, "
        f"CAST({amount} AS BIGINT) AS AMOUNT, CAST({share} AS DOUBLE) AS SHARE FROM ({sql[report]}) r"
        + (" WHERE PRV_NAME IS NOT NULL" if output == "map_stats" else "")
        for output, report, key, name, amount, share in JOB_OUTPUTS
    ]
    return "\nUNION ALL\n".join(parts)


def all_sql() -> dict[str, str]:
    sql = _report_sql()
    return {**sql, "job_outputs": _job_outputs(sql)}


def _report_sql() -> dict[str, str]:
    return {
        # sources (written as pipe-delimited files, read back with the schema)
        "scan_candidates": q("SELECT CONTEST_CODE, CANDIDATE_CODE, CANDIDATE_NAME FROM candidates"),
        "scan_contests": q("SELECT CONTEST_CODE FROM contests"),
        "scan_parties": q("SELECT PARTIES_CODE, PARTIES_NAME, PARTIES_ALIAS FROM parties"),
        "scan_precincts": q("SELECT VCM_ID, REG_NAME, PRV_NAME, CLUSTERED_PREC, REGISTERED_VOTERS FROM precincts"),
        "scan_results": q("SELECT * FROM results"),
        "merged_results": q(
            "SELECT PRECINCT_CODE, CONTEST_CODE, CANDIDATE_CODE, PARTY_CODE, VOTES_AMOUNT, TOTALIZATION_ORDER, "
            "NUMBER_VOTERS, UNDERVOTE, OVERVOTE, RECEPTION_DATE, REG_NAME, PRV_NAME, REGISTERED_VOTERS FROM merged"
        ),
        # projections / predicates
        "project_columns": q(
            "SELECT PRECINCT_CODE, PRV_NAME, UNDERVOTE, OVERVOTE, NUMBER_VOTERS, REGISTERED_VOTERS FROM merged"
        ),
        "filter_national": q(
            f"SELECT PRV_NAME, CONTEST_CODE, CANDIDATE_CODE, VOTES_AMOUNT FROM merged WHERE CONTEST_CODE IN {NATIONAL}"
        ),
        "filter_local": q(
            f"SELECT CONTEST_CODE, CANDIDATE_CODE, VOTES_AMOUNT FROM merged WHERE CONTEST_CODE NOT IN {NATIONAL}"
        ),
        # joins
        "transmission_flag": q("SELECT CLUSTERED_PREC, PRV_NAME, REGISTERED_VOTERS, TRANSMITTED FROM tf", TF),
        "precincts_reported": q(
            "SELECT * FROM precincts p WHERE EXISTS (SELECT 1 FROM results r WHERE r.PRECINCT_CODE = p.CLUSTERED_PREC)"
        ),
        "precincts_missing": q(
            "SELECT * FROM precincts p "
            "WHERE NOT EXISTS (SELECT 1 FROM results r WHERE r.PRECINCT_CODE = p.CLUSTERED_PREC)"
        ),
        "join_turnout_spoiled": q("SELECT * FROM jts", JTS),
        # aggregations
        "distinct_reporting": q("SELECT DISTINCT PRECINCT_CODE FROM results"),
        "one_row_per_precinct": q(
            "SELECT PRECINCT_CODE, PRV_NAME, UNDERVOTE, OVERVOTE, NUMBER_VOTERS, REGISTERED_VOTERS FROM pb"
        ),
        "precinct_count": q(
            "SELECT CAST(count(DISTINCT CLUSTERED_PREC) "
            "+ coalesce(max(CASE WHEN CLUSTERED_PREC IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) "
            "AS total_number_of_precincts FROM precincts"
        ),
        "voters_by_province": q(f"SELECT PRV_NAME, {_s('NUMBER_VOTERS')} FROM pb GROUP BY PRV_NAME"),
        "votes_by_contest_candidate": VOTES_BY_CONTEST_CANDIDATE,
        "votes_by_province_candidate": q("SELECT * FROM nat_prv", NAT_PRV),
        "split_by_contest": q("SELECT CONTEST_CODE, count(*) AS RESULT_ROWS FROM merged GROUP BY CONTEST_CODE"),
        # reports
        "tally_national": TALLY_NATIONAL,
        "tally_local": TALLY_LOCAL,
        "tally_national_province": TALLY_NATIONAL_PROVINCE,
        "leading_candidate_province": LEADING,
        "candidate_by_region": CANDIDATE_BY_REGION,
        "candidate_by_region_once": _by_region("results"),
        "transmission_by_province": q(
            "SELECT PRV_NAME, total_clustered_precincts, vcm_transmitted, vcm_not_transmitted, "
            "number_of_voters_not_transmitted, vcm_transmitted_percentile FROM tbp",
            TBP,
        ),
        "voter_stats_by_province": q("SELECT * FROM vsp", VSP),
        "map_stats": MAP_STATS,
        "map_stats_json": MAP_STATS_JSON,
        "voter_stats": q(f"SELECT {', '.join(VOTER_STATS_FIELDS)} FROM vs", VOTER_STATS),
        "voter_stats_json": q(
            "SELECT CAST(to_json(struct_pack("
            + ", ".join(f"{f} := {f}" for f in VOTER_STATS_FIELDS)
            + ")) AS VARCHAR) AS VOTER_STATS_JSON FROM vs",
            VOTER_STATS,
        ),
        "vcm_received": VCM_RECEIVED,
        "reception_rate_text": q(
            "SELECT substring(RECEPTION_DATE, 1, 10) AS RECEPTION_DATE_ONLY, "
            "substring(RECEPTION_DATE, 12, 2) AS RECEPTION_HOUR, "
            "substring(RECEPTION_DATE, 15, 2) AS RECEPTION_MINUTE, count(*) AS VCM_COUNT "
            "FROM merged GROUP BY 1, 2, 3"
        ),
        "turnout_by_precinct": q(
            f"SELECT PRECINCT_CODE, NUMBER_VOTERS, REGISTERED_VOTERS, {TURNOUT} AS VOTER_TURNOUT FROM pb"
        ),
        "spoiled_ballots": SPOILED_BALLOTS,
        "turnout_spoiled_correlation": q(
            "SELECT round(corr(SPOILED_PERCENTAGE, VOTER_TURNOUT), 9) AS correlation FROM jts "
            "WHERE VOTER_TURNOUT IS NOT NULL AND SPOILED_PERCENTAGE IS NOT NULL",
            JTS,
        ),
        "turnout_spoiled_correlation_finite": CORRELATION_FINITE,
        # corrected variants
        "vcm_received_by_time": q(
            """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS RECEPTION_TIME,
       CAST(sum(n) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS VCM_RECEIVED
FROM c""",
            f"{RT},\nc AS (SELECT ts, count(*) AS n FROM rt WHERE ts IS NOT NULL GROUP BY ts)",
        ),
        "reception_rate_by_minute": RECEPTION_BY_MINUTE,
        # sinks (written, then read back)
        "sink_csv_roundtrip": SPOILED_BALLOTS,
        "sink_by_contest": NATIONAL_AND_LOCAL,
        "sink_by_province": q(
            "SELECT CANDIDATE_NAME, VOTES_AMOUNT, PERCENTAGE, CONTEST_CODE, replace(PRV_NAME, ' ', '_') AS PRV_KEY "
            "FROM tnp",
            TALLY_NATIONAL_PROVINCE_CTE,
        ),
        "sink_province_order": q(
            "SELECT CONTEST_CODE, replace(PRV_NAME, ' ', '_') AS PRV_KEY, "
            "CAST(row_number() OVER (PARTITION BY CONTEST_CODE, PRV_NAME ORDER BY VOTES_AMOUNT DESC) AS INTEGER) AS POSITION, "
            "VOTES_AMOUNT FROM tnp",
            TALLY_NATIONAL_PROVINCE_CTE,
        ),
        "sink_reception_order": "SELECT *, CAST(row_number() OVER (PARTITION BY substring(RECEPTION_DATE, 1, 10) "
        f"ORDER BY RECEPTION_DATE NULLS FIRST) AS INTEGER) AS POSITION FROM ({VCM_RECEIVED}) v",
        "sink_reception_positions": f"SELECT *, row_number() OVER (ORDER BY RECEPTION_DATE NULLS FIRST) AS POSITION FROM ({VCM_RECEIVED}) v",
        "sink_map_leaders": LEADING,
        "sink_correlation_json": CORRELATION_FINITE,
        "sink_map_document": "SELECT CAST(row_number() OVER (ORDER BY PRV_NAME) - 1 AS INTEGER) AS POSITION, "
        f"PRV_NAME, STATS_JSON FROM ({MAP_STATS_JSON}) m",
        # streaming (run to completion with availableNow)
        "stream_snapshot_tally": TALLY_NATIONAL,
        "stream_running_tally": q(
            f"SELECT CONTEST_CODE, CANDIDATE_CODE, {_s('VOTES_AMOUNT')} FROM results GROUP BY 1, 2"
        ),
        "stream_reception_rate": RECEPTION_BY_MINUTE,
    }
