import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return SF


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture
def frame(spark):
    """A documents-like frame of texts; ids count from 0 unless given."""
    def make(texts, ids=None, schema="doc_id long, text string"):
        ids = list(range(len(texts))) if ids is None else ids
        return spark.createDataFrame(list(zip(ids, texts)), schema)
    return make
