from __future__ import annotations

import hashlib
import json
from datetime import timedelta

import pytest

from deskwright import fixed
from deskwright.rules import QualityRules
from deskwright.session import scratch_path

DOCUMENT = {
    "schema_version": 1,
    "batch_size": 1000,
    "source_system": "harbour-desk",
    "reference_time": "2026-02-03T04:05:06Z",
    "timeliness_days": 150,
    "quality_threshold": 0.9,
    "required_fields": fixed.USUAL_REQUIRED_FIELDS,
    "status_mapping": {"reported": "Open", "being worked on": "In Progress", "over": "Closed"},
    "priority_mapping": {"whenever": "Low", "soon": "Medium", "at once": "Critical"},
    "allowed_statuses": fixed.STATUSES,
    "allowed_priorities": fixed.PRIORITIES,
}
KNOWN_HASH = "8a25a09f9744c76998f18308c20b803821141093ee64fa0c0f00a01de0e56681"


def test_config_hash_of_a_known_document():
    rules = QualityRules.from_dict(DOCUMENT)
    text = json.dumps(DOCUMENT, sort_keys=True, separators=(",", ":"))
    assert rules.config_hash == hashlib.sha256(text.encode()).hexdigest() == KNOWN_HASH
    assert rules.stale_before == rules.reference_time - timedelta(days=150)
    assert QualityRules.from_dict({**DOCUMENT, "quality_threshold": 1}).quality_threshold == 1.0


def test_mapping_keys_are_folded_and_values_trimmed():
    rules = QualityRules.from_dict({**DOCUMENT, "status_mapping": {" OPEN ": " Open "}})
    assert rules.status_mapping == {"open": "Open"}


@pytest.mark.parametrize(
    "change",
    [
        {"surprise": 1},
        {"batch_size": 0},
        {"batch_size": 50_001},
        {"timeliness_days": 3_651},
        {"quality_threshold": 1.1},
        {"source_system": "x"},
        {"reference_time": "2026-01-01T00:00:00"},
        {"schema_version": 0},
        {"required_fields": "title"},
        {"allowed_statuses": [1, 2]},
    ],
)
def test_bad_documents_are_refused(change):
    with pytest.raises(ValueError):
        QualityRules.from_dict({**DOCUMENT, **change})


def test_missing_keys_are_refused():
    with pytest.raises(ValueError, match="missing rule keys"):
        QualityRules.from_dict({"source_system": "desk"})


def test_loads_a_json_file(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(DOCUMENT), encoding="utf-8")
    assert QualityRules.from_file(path) == QualityRules.from_dict(DOCUMENT)


class FakeSession:
    """Just the parts of a session that name the shared folder."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master})()


def test_scratch_folder_is_the_shared_one():
    found = scratch_path(FakeSession("yarn", "s3a://shared/"), "x")
    assert found.startswith("s3a://shared/deskwright/session-") and "/x-" in found
    assert "deskwright" in scratch_path(FakeSession("local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession("yarn"), "x")
