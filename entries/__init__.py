"""The registered queries: every operator of the library over the given tables, next to its SQL counterpart.

Each query applies the library's own function; the SQL states the same result independently. Queries read their
tables whole. Where a feed's payload is needed, Spark writes it from table rows and the feed reads it back.
"""

from entries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
