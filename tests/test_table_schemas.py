"""The declared test-table schemas equal the schemas stored in the files."""

import os

from dealcast.sources.tables import SCHEMAS, load_table


def test_declared_schemas_match_files(spark, sf):
    for name in SCHEMAS:
        path = os.path.join(sf, f"{name}.parquet")
        inferred = spark.read.parquet(path).schema
        declared = load_table(spark, sf, name).schema
        assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in inferred], name
