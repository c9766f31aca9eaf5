"""Applied against local migrations, and the checks of transforms."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import raw_hash_of, sanitized_name
from .config import LocalMigration
from .state import State


class MigrationError(RuntimeError):
    """Local files and the recorded state do not agree."""


def as_table(spark: SparkSession, local: list[LocalMigration]) -> DataFrame:
    return spark.createDataFrame([(m.mapping.version, m.mapping.name, m.content_hash) for m in local], "version int, mapping_name string, content_hash string")


def status(local: DataFrame, applied: DataFrame) -> DataFrame:
    """Each local migration as applied, pending or mismatched."""
    there = applied.select("version", "mapping_name", F.col("content_hash").alias("recorded"))
    state = F.when(F.col("recorded").isNull(), "pending").when(F.col("recorded") == F.col("content_hash"), "applied").otherwise("mismatched")
    return local.join(there, ["version", "mapping_name"], "left").select("version", "mapping_name", state.alias("state"))


@dataclass(frozen=True)
class Found:
    applied: list[tuple[int, str]]
    pending: list[tuple[int, str]]
    mismatched: list[tuple[int, str]]


class Tracker:
    """Which migrations of a project are applied."""

    def __init__(self, state: State):
        self.state = state

    def validate(self, local: list[LocalMigration]) -> Found:
        rows = status(as_table(self.state.spark, local), self.state.migrations()).orderBy("version", "mapping_name").collect()
        return Found(*[[(r.version, r.mapping_name) for r in rows if r.state == s] for s in ("applied", "pending", "mismatched")])

    def validate_or_fail(self, local: list[LocalMigration], allow_pending: bool = False) -> Found:
        found = self.validate(local)
        if found.mismatched:
            raise MigrationError("changed after they were applied: " + ", ".join(f"{v} {n}" for v, n in found.mismatched))
        if found.pending and not allow_pending:
            raise MigrationError("not applied yet: " + ", ".join(f"{v} {n}" for v, n in found.pending))
        return found

    def apply(self, local: list[LocalMigration], dry_run: bool = False) -> list[str]:
        """Record what is pending; fails if an applied file has changed."""
        found = self.validate_or_fail(local, allow_pending=True)
        names = [f"{v} {n}" for v, n in found.pending]
        if not dry_run:
            for m in local:
                if m.key in found.pending:
                    self.state.record_migration(*m.key, m.content_hash)
                    self.state.store_migration_content(*m.key, m.content)
        return names


def next_version(state_or_local: list[LocalMigration]) -> int:
    return max((m.mapping.version for m in state_or_local), default=0) + 1


def file_name(version: int, name: str) -> str:
    return f"{version:04d}_{sanitized_name(name)}.toml"


def transform_path(root: Path, m: LocalMigration) -> Path | None:
    """The transform of a mapping: the file that it names, else one with the mapping's name."""
    if m.mapping.transform.path:
        return root / m.mapping.transform.path
    implicit = root / "transforms" / f"{m.mapping.name}.py"
    return implicit if implicit.exists() else None


def unreferenced(files: DataFrame, referenced: DataFrame) -> DataFrame:
    """Transform files (column ``path``) that no mapping refers to."""
    return files.join(referenced.select("path").distinct(), "path", "left_anti")


def unreferenced_files(root: Path, local: list[LocalMigration]) -> list[str]:
    used = {p.resolve() for m in local if (p := transform_path(root, m))}
    return sorted(str(f.relative_to(root)) for f in (root / "transforms").glob("*.py") if f.resolve() not in used and f.name != "__init__.py")


def changed_transforms(root: Path, state: State, local: list[LocalMigration]) -> list[str]:
    """Mappings whose transform differs from the stored one; a missing file is none."""
    stored = {(r.version, r.mapping_name): r.content_hash for r in state.transforms().collect()}
    out = []
    for m in local:
        path = transform_path(root, m)
        if path and path.exists() and m.key in stored and raw_hash_of(path.read_text(encoding="utf-8")) != stored[m.key]:
            out.append(m.mapping.name)
    return out


def prints_to_stdout(root: Path) -> list[str]:
    """Transforms that print, which would mix with a worker's protocol."""
    return sorted(f.name for f in (root / "transforms").glob("*.py") if any(x.lstrip().startswith("print(") for x in f.read_text(encoding="utf-8").splitlines()))


def store_transforms(root: Path, state: State, local: list[LocalMigration]) -> None:
    for m in local:
        path = transform_path(root, m)
        if path and path.exists():
            text = path.read_text(encoding="utf-8")
            state.store_transform(m.mapping.name, m.mapping.version, text, raw_hash_of(text))
