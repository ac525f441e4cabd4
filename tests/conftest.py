import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickhouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", storage=str(tmp_path_factory.mktemp("shared")),
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
           "spark.log.level": "ERROR"},
    )
    yield session
    session.stop()


def rows(df, *order):
    """Rows as plain dicts, ordered."""
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]
