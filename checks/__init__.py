"""Role views over the test tables, registered queries, and their SQL counterparts."""
