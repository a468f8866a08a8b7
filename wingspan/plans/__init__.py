"""Named queries: the ``queries()`` / ``oracle_sql()`` registry."""

from wingspan.plans.registry import all_oracles, all_queries  # noqa: F401
