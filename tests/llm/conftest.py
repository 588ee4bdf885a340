"""Shared frames of the training-data operator tests."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from tickhouse.llm.common import ship

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for their own columns
        T.StructField("key", T.StringType()),
        T.StructField("tie", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("bits", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.StringType()),
    ]
)


@pytest.fixture(autouse=True)
def _package_on_workers(spark):
    ship(spark)


@pytest.fixture(scope="session")
def words():
    r = random.Random(5)
    parts = ["ta", "ri", "mo", "ken", "su", "é", "ß", "Lo", "ing", "s"]
    return ["".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(400)]


def prose(words, seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        out.append(r.choice(words) + r.choice(["", "", "", ",", ".", ".\n"]))
    return " ".join(out)


@pytest.fixture(scope="session")
def texts(words):
    """Ties, copies, nulls, empties, white space, junk and one very long text."""
    plain = [prose(words, i, 5 + 7 * i) for i in range(24)]
    return [
        *plain,
        plain[3],
        plain[3].upper(),
        plain[5],
        None,
        "",
        " \n\t ",
        "one",
        "One two",
        "\x00 odd 中文 😀   ​ end",
        "!!! *** $$$ ||| " * 20,
        "same line\n" * 30,
        prose(words, 99, 60_000),
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [
        (i, t, "en", "src0", len(t or ""), "k", 1, 2, 3, 4, "x") for i, t in enumerate(texts)
    ]
    rows += [rows[2], rows[2]]  # repeated rows
    rows += [(None, texts[4], "en", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def collected(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
