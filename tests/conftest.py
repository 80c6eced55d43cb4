import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from candor.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture()
def evaluate(spark):
    """evaluate(texts, column function) -> list of results, in one Spark job."""
    from pyspark.sql import functions as F

    def run(texts, use):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r["r"] for r in rows.select("i", use(F.col("t")).alias("r")).orderBy("i").collect()]

    return run
