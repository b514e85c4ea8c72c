import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def one(spark):
    """Evaluate an expression over one text per row; keeps the order of the inputs."""
    def run(values, expression, type_="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
        rows = df.select("i", expression(F.col("v")).alias("out")).collect()
        return [r["out"] for r in sorted(rows, key=lambda r: r["i"])]
    return run
