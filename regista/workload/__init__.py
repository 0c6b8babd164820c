"""The operators run over the given test tables, each with an independent SQL statement.

Roles: ``lineitem`` is the facility register (capacity, inscription date), ``part`` its service
types, ``supplier`` the municipalities, ``nation`` the counties, ``orders`` the census.
"""

from regista.workload import (  # noqa: F401  (importing registers the queries)
    documents,
    geometry,
    indicators,
    matching,
    panel,
    quality,
    relational,
    scalars,
    storage,
)
from regista.workload.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
