from canvass.sources.bundle import Election, merged_results  # noqa: F401
from canvass.sources.delimited import load_election, read_table, read_tables  # noqa: F401
