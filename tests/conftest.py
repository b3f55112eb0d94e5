import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from cardpulse.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session("cardpulse-tests", "local[8]", 8, **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.maxMetadataStringLength": "2000"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


NOON = datetime(2024, 5, 1, 12, 0, tzinfo=timezone.utc)


def at(seconds: float = 0.0) -> datetime:
    """A moment ``seconds`` after noon."""
    return NOON + timedelta(seconds=seconds)


TX_DDL = (
    "transaction_id string, user_id string, amount double, status string, failure_reason string, "
    "merchant_country string, user_country string, device_id string, event_time timestamp"
)


def tx_rows(spark, rows):
    """rows: (id, user, amount, status, reason, merchant country, device, seconds after noon)."""
    return spark.createDataFrame(
        [(i, u, a, s, r, m, "FR", d, None if t is None else at(t)) for i, u, a, s, r, m, d, t in rows], TX_DDL)
