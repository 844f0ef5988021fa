"""Which months of a table changed since another table was made of them.

Every replace writes new files into the partitions it touches and leaves the others alone, so the file names of a
partition tell its state. A table made of others keeps the states it was made of; months whose state differs are those to make
anew. Nothing has to be announced by the writer: after a crash, or when a step is left out, the next comparison finds
the same months again.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from martloom.sinks.store import Mart

UNDIVIDED = "*"


def states(mart: Mart, table: str, key: str) -> dict[str, str]:
    """State of every value of a partition column; a table without such a column has one state for all its rows."""
    if not mart.exists(table):
        return {}
    # A given schema spares the footers; only names are listed, by Spark's own file index.
    names: dict[str, list[str]] = {}
    for file in mart.spark.read.schema("_ INT").parquet(mart.path(table)).inputFiles():
        inside = file.split(f"/{table}/", 1)[-1]
        value = re.match(rf"(?:[^/]+/)*?{re.escape(key)}=([^/]+)/", inside)
        names.setdefault(unquote(value[1]) if value else UNDIVIDED, []).append(inside)
    return {v: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest() for v, n in names.items()}


def _kept(reader: str) -> str:
    return f"InputsOf{reader}"


def remember(mart: Mart, reader: str, seen: dict[str, dict[str, str]]) -> None:
    """Keep the states of its sources that a table was made of."""
    rows = [(s, v, state) for s, values in seen.items() for v, state in values.items()]
    mart.overwrite(_kept(reader), mart.spark.createDataFrame(rows, "source STRING, value STRING, state STRING").coalesce(1))


def changed(mart: Mart, reader: str, seen: dict[str, dict[str, str]]) -> set[str] | None:
    """Values whose state is not the one `reader` was made of, gone ones included; None when all may have changed."""
    if not mart.exists(reader) or not mart.exists(_kept(reader)):
        return None
    # A row per source and month.
    old = {(r["source"], r["value"]): r["state"] for r in mart.read(_kept(reader)).toLocalIterator()}
    new = {(s, v): state for s, values in seen.items() for v, state in values.items()}
    differ = {v for s, v in old.keys() | new.keys() if old.get((s, v)) != new.get((s, v))}
    return None if UNDIVIDED in differ else differ
