from __future__ import annotations

import pytest
from llm.cases import ODD_ROWS, SCHEMA
from pyspark.sql import functions as F

from trendlake.llm._ship import prepare


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing():
    """Adds columns with the names of results, of helpers and of given columns in another case."""

    def add(df, *names):
        more = [F.lit(i).alias(n) for i, n in enumerate(names)]
        return df.select("*", *more, F.lit("x").alias("TEXT"), F.lit("y").alias("_row"), F.lit(0).alias("a.b"), F.lit(1).alias("Doc_Id"))

    return add
