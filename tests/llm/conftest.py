import random

import duckdb
import pytest

from conftest import DATA

SF = DATA / "sf0.001"


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(str(SF / f"{name}.parquet"))


@pytest.fixture(scope="session")
def documents():
    """doc_id to text of the small table."""
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture
def duck():
    connection = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF / name}.parquet'")
    return connection


@pytest.fixture
def prose():
    """Random words from a small vocabulary, by a seed."""

    def make(seed, n, vocabulary=400):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))

    return make
