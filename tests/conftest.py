import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


class Compare:
    """Runs a query and its SQL over the same tables and compares the rows."""

    def __init__(self, spark, data: str) -> None:
        import duckdb

        self.spark, self.data, self.db = spark, data, duckdb.connect()
        for name in os.listdir(data):
            if name.endswith(".parquet"):
                self.db.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{data}/{name}'")

    @staticmethod
    def rows(frame) -> list[tuple]:
        plain = lambda v: None if v is None or v != v else (v.item() if hasattr(v, "item") else v)
        columns = sorted(frame.columns)
        return sorted((tuple(map(plain, r)) for r in frame[columns].values.tolist()), key=repr)

    def __call__(self, query, sql: str) -> int:
        got, want = query(self.spark, self.data).toPandas(), self.db.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        a, b = self.rows(got), self.rows(want)
        assert len(a) == len(b)
        for x, y in zip(a, b, strict=True):
            assert x == y
        return len(a)


@pytest.fixture(scope="session")
def compare(spark, data):
    return Compare(spark, data)
