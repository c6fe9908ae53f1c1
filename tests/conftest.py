import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession
from support import SF

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g"}
    builder = SparkSession.builder.master("local[4]").appName("tests")
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    """DuckDB with the tables of the smallest scale factor as views."""
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection
