import pytest


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return [(row.doc_id, row.text) for row in spark.read.parquet(f"{folder}/documents.parquet").collect()]
