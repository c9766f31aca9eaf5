"""Mapping files: TOML read, checked and turned into mappings."""

from __future__ import annotations

import os
import re
import tomllib
from collections.abc import Mapping as Environment
from dataclasses import dataclass
from pathlib import Path

from ..functions.text import content_hash_of, prefixed_name, resolve
from ..model import ID_TYPES, MEMBERSHIP_MODES, TRANSFORM_TYPES, VERSIONING_MODES, Batching, ConfigError, Mapping, Membership, Transform, Versioning
from ..operators import predicate

DEFAULT_TRANSFORM_BATCH, DEFAULT_UPLOAD_BATCH, DEFAULT_RETRIES = 100, 500, 5


@dataclass(frozen=True)
class LocalMigration:
    """A mapping file: its mapping and its text."""

    mapping: Mapping
    content: str
    file: str = ""

    @property
    def key(self) -> tuple[int, str]:
        return self.mapping.version, self.mapping.name

    @property
    def content_hash(self) -> str:
        return content_hash_of(self.content)


def _section(config: dict, name: str, required: bool = False) -> dict:
    found = config.get(name)
    if found is None and not required:
        return {}
    if not isinstance(found, dict):
        raise ConfigError(f"missing section [{name}]")
    return found


def _text(section: dict, key: str, where: str) -> str:
    found = section.get(key)
    if not isinstance(found, str) or not found:
        raise ConfigError(f"missing {where}.{key}" if where else f"missing {key}")
    return found


def _one_of(value: str, options: tuple[str, ...], where: str) -> str:
    if value not in options:
        raise ConfigError(f"{where} must be one of {', '.join(options)}, not {value!r}")
    return value


def parse(text: str, prefix: str | None = None) -> Mapping:
    """A mapping file's text as a mapping.

    ``columns`` must stand before the first section (TOML puts it into the
    section otherwise); since a list lost that way changes documents silently,
    it is an error here.  Other unknown keys are ignored.
    """
    try:
        config = tomllib.loads(text)
    except tomllib.TOMLDecodeError as bad:
        raise ConfigError(f"not TOML: {bad}") from bad
    version = config.get("version")
    if not isinstance(version, int) or isinstance(version, bool) or version <= 0:
        raise ConfigError(f"version must be a positive integer, not {version!r}")
    source, identity = _section(config, "source", True), _section(config, "id", True)
    for name, section in config.items():
        if isinstance(section, dict) and "columns" in section:
            raise ConfigError(f"columns stands inside [{name}]; move it before the first section")
    columns = config.get("columns", [])
    if not isinstance(columns, list) or not all(isinstance(c, str) for c in columns):
        raise ConfigError("columns must be a list of names")
    member, transform, batching, versioning = (_section(config, s) for s in ("membership", "transform", "batching", "versioning"))
    mode = _one_of(member.get("mode", "all"), MEMBERSHIP_MODES, "membership.mode")
    text_of = member.get("predicate")
    if mode == "dsl":
        if not text_of:
            raise ConfigError("membership mode dsl needs a predicate")
        try:
            predicate.parse(text_of)
        except predicate.PredicateError as bad:
            raise ConfigError(f"invalid predicate: {bad}") from bad
    by = _one_of(versioning.get("mode", "source_lsn"), VERSIONING_MODES, "versioning.mode")
    if by == "column" and not versioning.get("column"):
        raise ConfigError("versioning mode column needs a column")
    default = Batching()
    return Mapping(
        name=_text(config, "mapping_name", ""),
        namespace=prefixed_name(_text(config, "namespace", ""), prefix),
        schema=_text(source, "schema", "source"),
        table=source.get("table") or _text(source, "view", "source"),
        id_column=_text(identity, "column", "id"),
        id_type=_one_of(identity.get("type", ""), ID_TYPES, "id.type"),
        version=version,
        columns=tuple(columns),
        membership=Membership(mode, text_of),
        transform=Transform(_one_of(transform.get("type", "identity"), TRANSFORM_TYPES, "transform.type"), transform.get("path"), transform.get("entry")),
        batching=Batching(batching.get("batch_max_rows", default.max_rows), batching.get("batch_max_bytes", default.max_bytes), batching.get("flush_interval_ms", default.flush_interval_ms)),
        versioning=Versioning(by, versioning.get("column")),
    )


def load(folder: str | Path, prefix: str | None = None) -> list[LocalMigration]:
    """The mapping files of a project, by version."""
    found = []
    for file in sorted(Path(folder).glob("*.toml")):
        text = file.read_text(encoding="utf-8")
        try:
            found.append(LocalMigration(parse(text, prefix), text, file.name))
        except ConfigError as bad:
            raise ConfigError(f"{file.name}: {bad}") from bad
    return sorted(found, key=lambda m: m.key)


@dataclass(frozen=True)
class Project:
    """A project folder: ``migrations/``, ``transforms/`` and ``.env`` files."""

    root: Path
    environment: dict

    @property
    def migrations(self) -> Path:
        return self.root / "migrations"

    @property
    def transforms(self) -> Path:
        return self.root / "transforms"

    def setting(self, name: str, default: int) -> int:
        """A positive number from the environment, else the default."""
        text = self.environment.get(name, "")
        return int(text) if text.isdigit() and int(text) > 0 else default

    @property
    def prefix(self) -> str | None:
        return resolve(self.environment.get("BASE_NAMESPACE", ""), self.environment) or None

    def load(self) -> list[LocalMigration]:
        return load(self.migrations, self.prefix)


ASSIGNMENT = re.compile(r"^\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*$")


def read_env(file: Path) -> dict[str, str]:
    out = {}
    for line in file.read_text(encoding="utf-8").splitlines():
        if line.lstrip().startswith("#") or not (m := ASSIGNMENT.match(line)):
            continue
        value = m[2]
        out[m[1]] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value.split(" #")[0].rstrip()
    return out


def layered_env(start: Path, name: str | None = None, environment: Environment[str, str] | None = None) -> dict[str, str]:
    """The process's variables over those of the nearest folder with ``.env``
    files (``.env.<name>.local``, ``.env.local``, ``.env.<name>``, ``.env``, the first wins)."""
    environment = os.environ if environment is None else environment
    files = [*([f".env.{name}.local"] if name else []), ".env.local", *([f".env.{name}"] if name else []), ".env"]
    out: dict[str, str] = {}
    for folder in [start, *start.parents]:
        there = [folder / f for f in files if (folder / f).is_file()]
        if there:
            for file in reversed(there):
                out |= read_env(file)
            break
    return out | dict(environment)


def project(root: str | Path = ".", environment: Environment[str, str] | None = None) -> Project:
    """The project at ``root``; it must have a ``migrations`` folder."""
    root = Path(root).resolve()
    if not (root / "migrations").is_dir():
        raise ConfigError(f"no migrations folder in {root}; run init first")
    return Project(root, layered_env(root, (environment or os.environ).get("APP_ENV"), environment))
