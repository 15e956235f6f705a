import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trackspark import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ts():
    """Instant from UTC text."""

    def make(text):
        return None if text is None else datetime.fromisoformat(text).replace(tzinfo=timezone.utc)

    return make


def bag(df):
    """Rows as sorted plain tuples, instants as UTC text."""

    def plain(v):
        if isinstance(v, datetime):
            return v.isoformat(sep=" ")
        return v

    from pyspark.sql import types as T

    for f in df.schema:
        if isinstance(f.dataType, T.TimestampType):
            df = df.withColumn(f.name, df[f"`{f.name}`"].cast("timestamp_ntz"))
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])
