"""Pipeline configuration from YAML."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

import yaml


class ConfigError(ValueError):
    """The configuration is incomplete or contradicts itself."""


@dataclass(frozen=True)
class Destination:
    id: str
    routing_value: str
    path: str
    properties: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Config:
    source_path: str
    routing_field: str
    destinations: tuple[Destination, ...]
    key_columns: tuple[str, ...] = ()
    seed_mode: str = "scan"
    poll_seconds: int = 5
    instance: str = "default"
    mode: str = "all"
    include: tuple[str, ...] = ()
    total: int = 1
    ordinal: int = 0
    pairing: str = "compatible"

    @property
    def pipeline(self) -> str:
        return f"{Path(self.source_path).name}-{self.instance}"


def _text(value: object, name: str) -> str:
    if value is None or str(value) == "":
        raise ConfigError(f"{name} is missing")
    return str(value)


def _number(value: object, name: str, least: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < least:
        raise ConfigError(f"{name} must be a whole number of {least} or more")
    return value


def _env(section: dict, name: str) -> object:
    """section[name], or the environment variable that section[name + '_env'] names."""
    if variable := section.get(f"{name}_env"):
        if variable not in os.environ:
            raise ConfigError(f"environment variable {variable} is not set")
        return os.environ[variable]
    return section.get(name)


def _properties(section: object, where: str) -> dict[str, str]:
    """A mapping of text to text; `x_env: NAME` becomes x with the value of environment variable NAME."""
    if not isinstance(section, dict) or not all(isinstance(k, str) and isinstance(v, str) for k, v in section.items()):
        raise ConfigError(f"{where} must map strings to strings")
    return {k.removesuffix("_env"): _env(section, k.removesuffix("_env")) for k in section}


def _names(value: object, name: str) -> tuple[str, ...]:
    """A list of names; a bare string is no list of its letters."""
    if value is None:
        return ()
    if not isinstance(value, list | tuple) or not all(isinstance(v, str) and v for v in value):
        raise ConfigError(f"{name} must be a list of strings")
    return tuple(value)


def parse(raw: dict) -> Config:
    source, routing, instance = raw.get("source") or {}, raw.get("routing") or {}, raw.get("instance") or {}
    part, defaults = instance.get("partition") or {}, _properties((raw.get("defaults") or {}).get("properties") or {}, "defaults.properties")
    made = []
    for n, d in enumerate(raw.get("destinations") or []):
        properties = defaults | _properties(d.get("properties") or {}, f"destinations[{n}].properties")
        made.append(Destination(_text(d.get("id"), "destination id"), _text(d.get("routing_value"), "routing_value"), _text(_env(d, "path"), "destination path"), properties))
    if not made:
        raise ConfigError("there are no destinations")
    for what in ("id", "routing_value"):
        values = [getattr(d, what) for d in made]
        if len(set(values)) < len(values):
            raise ConfigError(f"destinations share a {what}")
    seed, mode = routing.get("seed_mode", "scan"), part.get("mode", "all")
    if seed not in ("scan", "cdc_replay"):
        raise ConfigError(f"unknown seed_mode {seed}")
    if mode not in ("all", "explicit", "hash"):
        raise ConfigError(f"unknown partition mode {mode}")
    total, ordinal = _number(part.get("total", 1), "partition.total", 1), _number(part.get("ordinal", 0), "partition.ordinal", 0)
    if ordinal >= total:
        raise ConfigError("partition.ordinal must be below partition.total")
    return Config(
        _text(_env(source, "path"), "source path"), _text(routing.get("field"), "routing.field"), tuple(made), _names(routing.get("key_columns"), "routing.key_columns"), seed,
        _number((raw.get("poll") or {}).get("interval_seconds", 5), "poll.interval_seconds", 1), str(instance.get("id", "default")), mode, _names(part.get("include"), "partition.include"), total, ordinal, routing.get("pairing", "compatible"),
    )


def load(path: str) -> Config:
    return parse(yaml.safe_load(Path(path).read_text()) or {})
