import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


SAMPLES = "metric string, labels map<string,string>, ts timestamp, value double"


@pytest.fixture(scope="session")
def make_samples(spark):
    """Samples from ``[(metric, labels, [values])]`` at one value per ``step`` seconds."""
    from datetime import datetime, timedelta, timezone

    def build(series, step=60, start=datetime(2026, 1, 1, tzinfo=timezone.utc)):
        rows = [
            (metric, labels, start + timedelta(seconds=step * i), float(v))
            for metric, labels, values in series
            for i, v in enumerate(values)
            if v is not None
        ]
        return spark.createDataFrame(rows, SAMPLES)

    return build
