import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from colloquy.session import local_session

    session = local_session(8, app="tests", memory="6g")
    yield session
    from colloquy.plans.shared import clear_scratch, shared_folder

    folder = Path(shared_folder(session).removeprefix("file:"))
    clear_scratch(session)
    assert not (folder / f"colloquy-{session.sparkContext.applicationId}").exists()
    session.stop()


@pytest.fixture
def cutting(spark):
    """Cut every group above a few rows, as a cluster does above hundreds of thousands."""
    from colloquy.plans.ordered_groups import HOT_ROWS_SETTING

    spark.conf.set(HOT_ROWS_SETTING, "4")
    yield
    spark.conf.unset(HOT_ROWS_SETTING)


@pytest.fixture(scope="session")
def duckdb_small():
    from check import SMALL, duck

    return duck(SMALL)
