from canvass.sinks.export import export_flat  # noqa: F401
from canvass.sinks.writers import (  # noqa: F401
    LINE_ORDER,
    read_csv,
    with_line_order,
    write_csv,
    write_delimited_tables,
    write_partitioned_csv,
    write_text,
)
