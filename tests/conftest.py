import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cohortry.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
