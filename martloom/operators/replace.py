"""Replace protocols as pure frames: what the table holds after the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def replace_window(target: DataFrame, incoming: DataFrame, stale: Column) -> DataFrame:
    """Drop target rows for which ``stale`` is true (NULL keeps the row), add ``incoming``."""
    return target.filter(~stale | stale.isNull()).unionByName(incoming)


def replace_keys(
    target: DataFrame, incoming: DataFrame, on: list[str], keys: DataFrame | None = None
) -> DataFrame:
    """Drop target rows whose key occurs in ``keys`` (default: in ``incoming``), add ``incoming``.

    NULL keys never match, as in a database join, so such rows stay.
    """
    gone = (incoming if keys is None else keys).select(*on).distinct()
    return target.join(gone, on, "left_anti").unionByName(incoming)
