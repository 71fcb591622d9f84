import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from casemill import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "casemill-tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to texts and return the results in order."""
    from pyspark.sql import functions as F

    def apply(fn, texts, type_="string"):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, f"i int, t {type_}").select("i", fn(F.col("t")).alias("x"))
        return [r["x"] for r in sorted(df.collect())]

    return apply
