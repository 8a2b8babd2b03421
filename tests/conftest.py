import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyscope.functions.lineage import clear_stages  # noqa: E402
from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("stages"))})
    yield session
    clear_stages(session)
    session.stop()
