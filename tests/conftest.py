import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from meterhouse.plans.fixtures import Tables  # noqa: E402
from meterhouse.session import CHECKPOINT_CONF, build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        **{CHECKPOINT_CONF.replace(".", "__"): str(tmp_path_factory.mktemp("work"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture
def rows_of():
    """Rows of a frame as sorted tuples."""

    def rows(df, *columns):
        names = columns or df.columns
        return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)

    return rows
