from __future__ import annotations

import random

import pytest

from corpuslab.llm import common

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, id string, n int, "
        "digest string, key int, label string, spans string, score int, a int, b int, _hash int, rank int, share int, gone int")


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    prose = " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(120))
    near = prose.replace("alpha", "alphx", 1)
    long = " ".join(rng.choice(words) for _ in range(60_000))
    return [None, "", " \t\n\x0b\x0c\r", "one", "one two", prose, prose, near, prose.upper(), prose + "\n", long,
            "mail a.b@c.org and +1 (234) 555-6789", "été 中文 \U0001f600 x", "1234 5678", "same same same same same"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rows = []
    for i, text in enumerate(odd_texts()):
        extra = (None,) * 15 if i % 2 else (3, "s", "x", 1, "d", 2, "l", "z", 4, 5, 6, 7, 8, 9, 10)
        rows.append((i, text, [None, "en", "de"][i % 3], [None, "s0", "s1"][i % 3], i, *extra))
    rows += [rows[5], rows[5], (None, "one two", None, None, None, *(None,) * 15), (None, None, None, None, None, *(None,) * 15)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return common.table(spark, sf, "documents")


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.select("doc_id", *columns).collect()}


@pytest.fixture(scope="session")
def rows_by_id():
    return by_id
