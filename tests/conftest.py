import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from shardweave.session import local_session  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8, "4g", "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts():
    import pyarrow.parquet as pq

    return pq.read_table(DATA / "documents.parquet").sort_by("doc_id")["text"].to_pylist()
