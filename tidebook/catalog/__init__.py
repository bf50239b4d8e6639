"""Named queries over the driver's tables, each with SQL that says the same.

``QUERIES[name]`` takes (spark, sf_dir); ``ORACLE[name]`` is DuckDB SQL for the
same base tables.
"""

from tidebook.catalog import (  # noqa: F401
    analysis,
    checks,
    dashboard,
    incremental,
    kpis,
    marts,
    measures,
    relational,
    scalars,
    sources,
)
from tidebook.catalog.base import ORACLE, QUERIES  # noqa: F401
