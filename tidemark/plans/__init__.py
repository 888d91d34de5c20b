"""All queries of the core library and their SQL."""

from __future__ import annotations


def queries():
    from . import core, files  # noqa: F401  files adds its queries to those of core

    return dict(core.QUERIES)


def oracle_sql():
    from . import core, files  # noqa: F401

    return dict(core.SQL)
