"""Job specs: ordered lists of named steps, read from YAML or given as dicts."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml

from .. import registry as R
from ..operators import augmenters as _a, cleaners as _c, preprocessors as _p  # noqa: F401  (register)


@dataclass(frozen=True)
class Step:
    name: str
    enabled: bool = True
    params: dict = field(default_factory=dict)
    description: str = ""


@dataclass(frozen=True)
class JobSpec:
    steps: dict[str, list[Step]]
    settings: dict = field(default_factory=dict)
    rest: dict = field(default_factory=dict)

    def enabled(self, section: str) -> list[Step]:
        return [s for s in self.steps.get(section, []) if s.enabled]

    def listing(self) -> list[dict]:
        """What the job would run, for people: one entry per step, disabled ones included."""
        return [
            {"section": sec, "name": s.name, "enabled": s.enabled, "description": s.description, "params": s.params}
            for sec, steps in self.steps.items()
            for s in steps
        ]


SECTIONS = {"cleaners": R.cleaners, "preprocessors": R.preprocessors, "augmenters": R.augmenters}


def read_yaml(path: str | Path) -> dict:
    with open(path, encoding="utf8") as f:
        return yaml.safe_load(f) or {}


def load_spec(spec: str | Path | dict | JobSpec) -> JobSpec:
    if isinstance(spec, JobSpec):
        return spec
    raw = spec if isinstance(spec, dict) else read_yaml(spec)
    steps = {}
    for section in SECTIONS:
        if section in raw:
            steps[section] = [
                Step(s["name"], s.get("enabled", True), s.get("params") or {}, s.get("description", ""))
                for s in raw[section] or []
            ]
    rest = {k: v for k, v in raw.items() if k not in SECTIONS and k != "settings"}
    return JobSpec(steps, raw.get("settings") or {}, rest)


def validate_spec(spec: JobSpec | dict | str, required: list[str]) -> list[str]:
    """Problems found without touching data: missing sections, unknown component names."""
    spec = load_spec(spec)
    present = {*spec.steps, *spec.rest}
    problems = [f"missing section '{s}'" for s in required if s not in present]
    for section, steps in spec.steps.items():
        registry = SECTIONS[section]
        problems += [f"unknown {registry.kind} '{s.name}'" for s in steps if s.name not in registry]
    return problems


def require_valid(spec: JobSpec | dict | str, required: list[str]) -> JobSpec:
    spec = load_spec(spec)
    problems = validate_spec(spec, required)
    if problems:
        raise ValueError("; ".join(problems))
    return spec
