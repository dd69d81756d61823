import os
import sys
from pathlib import Path

import pytest

for folder in (Path(__file__).resolve().parent.parent, Path(__file__).resolve().parent):
    sys.path.insert(0, str(folder))
DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent.parent))
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "3g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c
