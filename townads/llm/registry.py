"""All queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from townads.llm import (
    bpe,
    bwt_dedup,
    decontamination,
    language,
    lexical,
    licenses,
    neighbours,
    periodic,
    similar,
    substrings,
    token_counts,
    tool_calls,
    url_filter,
)

_MODULES = (
    bpe,
    bwt_dedup,
    decontamination,
    language,
    lexical,
    licenses,
    neighbours,
    periodic,
    similar,
    substrings,
    token_counts,
    tool_calls,
    url_filter,
)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLE", {}).items()}
