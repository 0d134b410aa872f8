import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from forgelake.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, 4, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Silver rows from short dicts; columns not given are NULL."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from forgelake.schemas import SILVER_TYPES, ddl

    def make(*events):
        full = []
        for n, event in enumerate(events):
            event = {"event_id": str(n), "actor_id": 1, "actor_login": "ann", "repo_id": 10,
                     "repo_name": "o/r", "created_at": "2024-01-01 00:00:00", **event}
            event["created_at"] = datetime.fromisoformat(event["created_at"])
            full.append(tuple(event.get(c) for c in SILVER_TYPES))
        df = spark.createDataFrame(full, ddl(SILVER_TYPES))
        return df.withColumn("event_date", F.to_date("created_at"))

    return make
