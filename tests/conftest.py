import json
import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from waybill.session import start  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = start("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def landing(tmp_path):
    """Writes landed files: ``landing("store/orders", page, page)`` puts one page per line."""
    root = tmp_path / "landing"

    def put(folder, *pages, name="pages.json", text=None):
        target = root / folder
        target.mkdir(parents=True, exist_ok=True)
        (target / name).write_text(text if text is not None else "\n".join(json.dumps(p) for p in pages) + "\n")
        return str(root)

    put.root = str(root)
    return put


@pytest.fixture
def as_of():
    return datetime(2024, 3, 31, 12, 0, tzinfo=UTC)
