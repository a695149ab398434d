from cityobs.sources.layout import Layout
from cityobs.sources.tables import (
    FORMATS,
    FormatUnavailable,
    publish,
    read_table,
    write_table,
)

__all__ = ["FORMATS", "FormatUnavailable", "Layout", "publish", "read_table", "write_table"]
