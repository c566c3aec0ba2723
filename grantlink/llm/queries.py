"""All corpus queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import align, binary, decontaminate, language, lm, mixing, quality, secrets, sharding, simhash, tokens, trie, urls

_MODULES = (sharding, quality, urls, simhash, decontaminate, mixing, language, lm, tokens, secrets, binary, align, trie)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
