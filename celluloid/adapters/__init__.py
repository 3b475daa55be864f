"""The given test tables shaped as film tables, the registered queries and their SQL counterparts."""
