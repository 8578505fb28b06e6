import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """The documents of the smallest tables, as (doc_id, text)."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


#: Nulls, empty and blank texts, ties, repeated rows.
ODD = [
    (None, "a null id with seven words here"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "two words"),
    (6, "a null id with seven words here"), (7, "x" * 5000), (8, "wide blanks and more\x00zero \U0001f600 end"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns named like those that operators use inside."""
    rows = [(i, t, "k", 1, None) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, row_key string, n int, `a.b` string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
