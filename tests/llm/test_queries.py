from __future__ import annotations

import pytest
from oracle import compare

from corpuslab.llm.queries import QUERIES


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_same_as_sql(spark, sf, name):
    ok, message, _ = compare(spark, sf, name, *QUERIES[name])
    assert ok, message
