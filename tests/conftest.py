import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tideline import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        spark_master="local[4]",
        spark_ui_enabled="false",
        spark_sql_shuffle_partitions="4",
        spark_sql_warehouse_dir=str(root / "warehouse"),
        spark_checkpoint_dir=str(root / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
