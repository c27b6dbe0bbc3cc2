"""Where the sources of a model build come from, by tier, and what a build may ask for."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from .texts import yaml_subset


@dataclass(frozen=True)
class Source:
    """A logical source: its file, layer and tier. required must exist, optional may be absent, flagged is needed if its flag is set."""

    key: str
    path: str | None
    layer: str | None
    tier: str
    exists: bool


@dataclass
class BuildConfig:
    sources: dict[str, Source]
    parameters: dict = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    def __getitem__(self, key: str) -> Source:
        return self.sources[key]


def load(folder: str, required: list[str], optional: list[str] = (), flags: dict[str, str] | None = None) -> BuildConfig:
    """Reads source.yaml and build.json of a folder. flags: flag of build.json -> source it needs.

    A missing required source, or one whose flag is set, is an error; a missing
    optional one is a warning.
    """
    def text(name: str) -> str:
        at = os.path.join(folder, name)
        return open(at).read() if os.path.exists(at) else ""

    listed = yaml_subset(text("source.yaml")) or {}
    parameters = yaml_subset(text("build.json")) if text("build.json") else {}
    unknown = set(listed) - set(required) - set(optional) - set((flags or {}).values())
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    config = BuildConfig({}, parameters)
    needed = {src for flag, src in (flags or {}).items() if parameters.get(flag)}
    for key in [*required, *optional, *(flags or {}).values()]:
        entry = listed.get(key)
        entry = {"file": entry} if isinstance(entry, str) else entry or {}
        path = os.path.join(folder, entry["file"]) if entry.get("file") else None
        there = bool(path and os.path.exists(path))
        tier = "required" if key in required else "flagged" if key in (flags or {}).values() else "optional"
        config.sources[key] = Source(key, path, entry.get("layer"), tier, there)
        if not there and (tier == "required" or key in needed):
            raise FileNotFoundError(f"source {key} is needed and not there: {path}")
        if not there:
            config.warnings.append(f"no {key}: what needs it is left out")
    return config
