"""Collects every registered query module."""

from __future__ import annotations


def _load():
    from footfall.plans import queries  # noqa: F401  (registers snapshot queries)
    from footfall.plans import queries_profile  # noqa: F401
    from footfall.plans import queries_eval  # noqa: F401
    from footfall.plans import queries_models  # noqa: F401
    from footfall.plans import queries_misc  # noqa: F401
    from footfall.plans import queries_closed  # noqa: F401
    from footfall.plans import queries_paths  # noqa: F401
    from footfall.plans import queries_linear  # noqa: F401
    return queries


def spark_queries():
    return dict(_load().SPARK)


def oracle_queries():
    return dict(_load().SQL)
