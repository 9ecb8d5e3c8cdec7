import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    return DATA


@pytest.fixture(scope="session")
def agrees(spark, data):
    """Whether a query gives the rows of its SQL, columns by name, floats to nine figures."""
    import duckdb

    connection = duckdb.connect()
    for file in os.listdir(data):
        if file.endswith(".parquet"):
            connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{data}/{file}')")

    def rows(columns, values):
        order = sorted(range(len(columns)), key=columns.__getitem__)
        return sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in values)

    def run(query, sql):
        found = query(spark, data)
        wanted = connection.execute(sql)
        names = [c[0] for c in wanted.description]
        assert sorted(found.columns) == sorted(names)
        assert rows(found.columns, map(tuple, found.collect())) == rows(names, wanted.fetchall())

    return run
