import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for Python workers

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{name}'")
    return con


@pytest.fixture
def same(spark, duck):
    """Whether a query gives the rows of its SQL on the small tables, columns by name, doubles to nine digits."""

    def plain(x):
        return f"{x:.9g}" if isinstance(x, float) else str(x)

    def compare(query, sql):
        found = query(spark, SMALL)
        columns = sorted(found.columns)
        rows = sorted([plain(r[c]) for c in columns] for r in found.collect())
        result = duck.execute(sql)
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert rows == sorted([plain(r[names.index(c)]) for c in columns] for r in result.fetchall())

    return compare
