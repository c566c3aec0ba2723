"""Registered queries: ``queries``, ``linkage`` and ``records`` fill one registry."""

from . import linkage, queries, records  # noqa: F401
