import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bidtide import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "local[4]",
        "tests",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def streaming(spark):
    return session.stream_session(spark)
