import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text), with columns whose names the operators use themselves."""

    def build(rows, schema="doc_id long, text string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, schema).repartition(3)
        for name in ("n", "raw", "sha", "fp", "spans", "blob", "kept", "_id", "cls", "token_ids", "score", "label", "h", "start"):
            df = df.withColumn(name, F.lit("mine"))
        return df

    return build
