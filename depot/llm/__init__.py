"""Training-data operators: formatting, filtering, deduplication, scoring,
extraction, archives, mixing and sharding.

Nothing outside this subpackage imports it.  ``queries()`` and
``oracle_sql()`` are read by the driver's entry module.
"""

from depot.llm.registered import oracle_sql, queries  # noqa: F401
