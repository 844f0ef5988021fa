"""A monthly sales mart built as Spark DataFrame jobs.

``plans`` holds the jobs (dimensions, facts, aggregates, mirrors), ``operators``
the join/replace/geo building blocks they share, ``functions`` the column
expressions, ``sources`` and ``sinks`` the input and output protocols.
"""
