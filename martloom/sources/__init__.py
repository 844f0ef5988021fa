from martloom.sources.boundary import read_boundary
from martloom.sources.jdbc import JdbcSource
from martloom.sources.landing import has_rows, read_landing, read_sheets, split_landing
from martloom.sources.tables import read_table

__all__ = ["JdbcSource", "has_rows", "read_boundary", "read_landing", "read_sheets", "read_table", "split_landing"]
