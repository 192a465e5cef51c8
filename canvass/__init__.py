"""canvass: precinct-level election results analytics on Apache Spark.

The package loads the five pipe-delimited election tables (results,
precincts, candidates, contests, parties), attaches precinct attributes to
the vote rows and computes tallies, leaders, transmission / turnout
statistics and reception timelines as DataFrame plans.

Layout
------
``sources``    readers (delimited files with explicit schemas) and the
               ``Election`` bundle; ``sources.testdata`` derives the five
               tables from the driver's TPC-H style test tables.
``functions``  Column-expression helpers with explicit null / NaN /
               zero-division semantics.
``operators``  reusable relational building blocks (representative row per
               key, top-1 per group, group shares, bucketed running totals,
               existence flags).
``plans``      the reports, composed from operators.
``sinks``      CSV / partitioned CSV / JSON-lines writers.
``streaming``  Structured Streaming variants (snapshot drops, running tally,
               live reception rate).
``job``        the named-report batch job (``python -m canvass.job``).
"""

from canvass.schema import NATIONAL_CONTESTS  # noqa: F401
