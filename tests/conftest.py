import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from grainledger.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="tests", shuffle_partitions="4", memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def frame(spark):
    """Rows from a short schema and tuples; timestamp and date columns may be given as text."""

    def make(schema, *rows):
        names = [c.split()[0] for c in schema.split(", ")]
        types = [c.split()[1] for c in schema.split(", ")]
        loose = ", ".join(f"{n} {'STRING' if t in ('TS', 'DATE') else t}" for n, t in zip(names, types))
        df = spark.createDataFrame(list(rows), loose)
        for n, t in zip(names, types):
            if t in ("TS", "DATE"):
                df = df.withColumn(n, df[n].cast("timestamp_ntz" if t == "TS" else "date"))
        return df

    return make
