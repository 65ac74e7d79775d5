"""The rules document: a small frozen object that becomes literals in the plan."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from datetime import datetime, timedelta
from pathlib import Path
from typing import Any

from deskwright import fixed


@dataclasses.dataclass(frozen=True)
class QualityRules:
    source_system: str
    reference_time: datetime
    required_fields: tuple[str, ...]
    status_mapping: dict[str, str]
    priority_mapping: dict[str, str]
    allowed_statuses: tuple[str, ...]
    allowed_priorities: tuple[str, ...]
    schema_version: int = 1
    batch_size: int = fixed.DEFAULT_BATCH_SIZE
    timeliness_days: int = fixed.DEFAULT_TIMELINESS_DAYS
    quality_threshold: float = fixed.DEFAULT_THRESHOLD

    def __post_init__(self) -> None:
        def check(name: str, value: float, low: float, high: float) -> None:
            if not low <= value <= high:
                raise ValueError(f"{name} must be between {low} and {high}, got {value}")

        check("schema_version", self.schema_version, 1, float("inf"))
        check("batch_size", self.batch_size, *fixed.BATCH_SIZE_BOUNDS)
        check("timeliness_days", self.timeliness_days, *fixed.TIMELINESS_BOUNDS)
        check("quality_threshold", self.quality_threshold, *fixed.THRESHOLD_BOUNDS)
        check("length of source_system", len(self.source_system), *fixed.SOURCE_SYSTEM_BOUNDS)
        if self.reference_time.tzinfo is None:
            raise ValueError("reference_time needs a time zone")

    @classmethod
    def from_dict(cls, document: dict[str, Any]) -> QualityRules:
        """Build rules from a parsed document; unknown and missing keys are errors."""
        fields = {f.name: f for f in dataclasses.fields(cls)}
        unknown = sorted(set(document) - set(fields))
        if unknown:
            raise ValueError(f"unknown rule keys: {', '.join(unknown)}")
        needed = [n for n, f in fields.items() if f.default is dataclasses.MISSING]
        absent = sorted(set(needed) - set(document))
        if absent:
            raise ValueError(f"missing rule keys: {', '.join(absent)}")
        values = dict(document)
        if isinstance(values["reference_time"], str):
            values["reference_time"] = datetime.fromisoformat(values["reference_time"])
        for name in ("required_fields", "allowed_statuses", "allowed_priorities"):
            if isinstance(values[name], str) or not all(isinstance(x, str) for x in values[name]):
                raise ValueError(f"{name} must be a list of texts")
            values[name] = tuple(values[name])
        if "quality_threshold" in values:
            values["quality_threshold"] = float(values["quality_threshold"])
        for name in ("status_mapping", "priority_mapping"):
            values[name] = {k.strip().casefold(): v.strip() for k, v in values[name].items()}
        return cls(**values)

    @classmethod
    def from_file(cls, path: str | Path) -> QualityRules:
        """Load a JSON document, or a YAML one when a YAML library is installed."""
        text = Path(path).read_text(encoding="utf-8")
        if str(path).endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as error:
                raise RuntimeError("YAML rules need the PyYAML package; use JSON") from error
            return cls.from_dict(yaml.safe_load(text))
        return cls.from_dict(json.loads(text))

    @property
    def stale_before(self) -> datetime:
        """Instant before which an update counts as stale."""
        return self.reference_time - timedelta(days=self.timeliness_days)

    def as_document(self) -> dict[str, Any]:
        document = dataclasses.asdict(self)
        document["reference_time"] = self.reference_time.isoformat().replace("+00:00", "Z")
        return document

    def to_json(self) -> str:
        return json.dumps(self.as_document(), sort_keys=True, separators=(",", ":"))

    @property
    def config_hash(self) -> str:
        """SHA-256 over the key-sorted compact JSON of every rule field."""
        return hashlib.sha256(self.to_json().encode()).hexdigest()
