"""Every registered query that has SQL gives the same rows in DuckDB."""

from __future__ import annotations

import pytest
from oracle import compare

from corpuslab.plans.registry import ALL


@pytest.mark.parametrize("name", [n for n, (_, sql) in ALL.items() if sql])
def test_same_as_sql(spark, sf, name):
    ok, message, _ = compare(spark, sf, name, *ALL[name])
    assert ok, message


def test_entry_runs(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert rows and set(contract.oracle_sql()) <= set(contract.queries())
