"""Structured Streaming variants of the reports.

* :mod:`snapshot`      every drop is a full snapshot that replaces the last
                       one (the polling-loop ingestion re-aimed as a file
                       stream with ``foreachBatch``).
* :mod:`running_tally` append-only result feed -> stateful running tally.
* :mod:`reception`     live machines per minute from each machine's earliest time.
"""
