from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from deskwright import fixed  # noqa: E402
from deskwright.rules import QualityRules  # noqa: E402
from deskwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "deskwright-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rules() -> QualityRules:
    return QualityRules(
        source_system="north-desk",
        reference_time=datetime(2031, 7, 15, 8, 30, tzinfo=timezone.utc),
        required_fields=("title", "description", "status", "requester_email", "updated_at"),
        status_mapping={"unread": "Open", "on hold": "Pending", "sorted": "Resolved"},
        priority_mapping={"drop everything": "Critical", "some day": "Low"},
        allowed_statuses=tuple(fixed.STATUSES),
        allowed_priorities=tuple(fixed.PRIORITIES),
        batch_size=2,
        timeliness_days=45,
        quality_threshold=0.7,
    )


@pytest.fixture
def good() -> dict[str, str]:
    who = "porter.gate4@desk.example"
    values = [
        "SD-1", "Badge reader at gate 4 stays red", f"Ask {who}, or ring +44 20 7946 0147 at noon",
        "Unread", "drop everything", who, "night-shift",
        "2031-07-14T10:00:00Z", "2031-07-14T10:05:00Z", "", "north-desk",
    ]
    return dict(zip(fixed.EXPORT_COLUMNS, values, strict=True))
