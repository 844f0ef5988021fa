from martloom.sinks.jdbc import JdbcSink
from martloom.sinks.store import Mart

__all__ = ["JdbcSink", "Mart"]
