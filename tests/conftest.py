import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from trolley import schemas  # noqa: E402
from trolley.session import build_session  # noqa: E402
from trolley.settings import Settings  # noqa: E402
from trolley.sources.decode import with_event_time  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        Settings(app_name="tests", master="local[8]"),
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.catalogImplementation": "in-memory",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_events(spark):
    """Events from (user, product, category, type, time text) tuples."""

    def make(*rows, day=None):
        fields = spark.createDataFrame(list(rows), schemas.EVENT_JSON)
        return with_event_time(fields, None if day is None else F.lit(day).cast("date"))

    return make


@pytest.fixture
def sample(make_events):
    """A morning in a lamp shop: ann and cid buy, bo, dot and eve only look."""
    return make_events(
        ("ann", "lamp", "light", "view", "2023-11-07T08:02:11"),
        ("bo", "lamp", "light", "view", "2023-11-07T08:03:40"),
        ("ann", "bulb", "light", "view", "2023-11-07T08:05:02"),
        ("cid", "rug", None, "view", "2023-11-07T08:20:59"),
        ("ann", "bulb", "light", "add_to_cart", "2023-11-07T08:21:00"),
        ("ann", "bulb", "light", "purchase", "2023-11-07T08:29:30"),
        ("dot", "lamp", "light", "view", "2023-11-07T09:00:00"),
        ("cid", "rug", None, "purchase", "2023-11-07T09:12:45"),
        ("eve", "bulb", "light", "view", "2023-11-07T09:13:07"),
        ("cid", "rug", None, "purchase", "2023-11-07T11:40:00"),
    )
