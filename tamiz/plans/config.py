"""Rule files: YAML or JSON, with the sections a job cannot do without."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any


class ConfigError(ValueError):
    """The rule file lacks a mandatory section or is not a mapping."""


def load_rules(path: str | Path, required: Iterable[str] = ()) -> dict[str, Any]:
    source = Path(path)
    if not source.exists():
        raise FileNotFoundError(f"rule file not found: {source}")
    body = source.read_text(encoding="utf-8")
    if source.suffix.lower() == ".json":
        config = json.loads(body)
    else:
        try:
            import yaml
        except ImportError as exc:
            raise ConfigError("reading YAML rule files needs PyYAML; use JSON instead") from exc
        config = yaml.safe_load(body)
    return check_sections(config, required, str(source))


def check_sections(config: Any, required: Iterable[str], origin: str = "config") -> dict[str, Any]:
    if not isinstance(config, Mapping):
        raise ConfigError(f"{origin}: expected a mapping of sections")
    gone = [s for s in required if s not in config]
    if gone:
        raise ConfigError(f"{origin}: missing sections {gone}")
    return dict(config)
