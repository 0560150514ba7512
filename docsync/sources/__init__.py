from docsync.sources.changes import changed_before, changed_between
from docsync.sources.jdbc import jdbc_query, jdbc_table
from docsync.sources.sql import by_keys, extension_rows, full, window

__all__ = [
    "by_keys", "changed_before", "changed_between", "extension_rows", "full", "jdbc_query",
    "jdbc_table", "window",
]
