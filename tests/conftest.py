import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpusmill.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("*", 4)
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts(spark):
    """A function from strings to a frame ``(id, text)``."""

    def build(values):
        return spark.createDataFrame(list(enumerate(values)), "id bigint, text string")

    return build
