import pytest


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""
    rows = [
        (1, "one two three four five six seven eight nine ten", "a"), (1, "one two three four five six seven eight nine ten", "a"), (2, "one two three four five six seven eight nine ten", None),
        (3, None, "b"), (4, "", "b"), (None, "lone words without any number at all here", "c"), (5, "x\n" * 3000 + "token = \"04dbebab91ab85687d33eeaaf9ac699e\" a.b@c.example", None), (6, " \t\x0b ", "d"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, id string").withColumnsRenamed({}).selectExpr("*", "id AS version", "id AS pos", "id AS run", "id AS shard", "id AS score", "id AS n")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
