import os

import pytest

SF = "/root/testdata/sf0.001"


def rows(df):
    """Rows as sorted plain tuples, nulls and all."""
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(os.path.join(SF, "documents.parquet"))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(os.path.join(SF, "labels.parquet"))
