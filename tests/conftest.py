import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--conf spark.ui.showConsoleProgress=false pyspark-shell")


@pytest.fixture(scope="session")
def spark():
    from tallyline.session import build_session

    session = build_session("tests", master="local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows of dicts as a table; columns and types come from a DDL string."""

    def make(rows, ddl):
        from pyspark.sql.types import StructType

        names = StructType.fromDDL(ddl).names
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)

    return make
