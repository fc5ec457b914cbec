"""Registered queries: every operator on views over the driver tables, with the same result in SQL."""

from .core import all_queries, all_oracles  # noqa: F401
