"""All registered queries with their checking SQL."""

from __future__ import annotations

from corpuslab.plans import queries_stream, queries_text, queries_vectors

ALL = {**queries_text.QUERIES, **queries_vectors.QUERIES, **queries_stream.QUERIES}


def queries() -> dict:
    return {name: function for name, (function, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
