import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quire.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="quire-tests")
    yield s


def col_values(spark, expr_fn, values, dtype="string"):
    """Evaluate a Column function over a one-column DataFrame, keeping order."""
    from pyspark.sql import functions as F

    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("x"))).collect()]
