"""Text helpers of migrations, transforms and reports."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Mapping as Environment

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(text: Column) -> Column:
    """SHA-256 in hexadecimal, the same for LF and CRLF line ends."""
    return F.sha2(F.replace(text, F.lit("\r\n"), F.lit("\n")), 256)


def content_hash_of(text: str) -> str:
    return hashlib.sha256(text.replace("\r\n", "\n").encode()).hexdigest()


def raw_hash_of(text: str) -> str:
    """The hash of a transform, whose line ends count."""
    return hashlib.sha256(text.encode()).hexdigest()


def truncated(text: Column, most: int) -> Column:
    """At most ``most`` characters, the last three of a longer text being dots."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(max(most - 3, 0))), F.lit("..."))).otherwise(text)


def sanitized(name: Column) -> Column:
    """A migration name: lower case, white space as underscore, else letters, digits, underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"\s", "_"), r"[^\p{L}\p{N}_]", "")


def sanitized_name(name: str) -> str:
    return "".join(c for c in re.sub(r"\s", "_", name.lower()) if c.isalnum() or c == "_")


def present_joined(*parts: Column) -> Column:
    """The parts that are neither null nor empty, joined by a space."""
    return F.concat_ws(" ", *[F.nullif(p.cast("string"), F.lit("")) for p in parts])


def duration(seconds: Column) -> Column:
    """Whole seconds as 1h2m3s, 2m3s or 3s."""
    s = F.floor(seconds).cast("long")
    h, m = (s / 3600).cast("long"), (s % 3600 / 60).cast("long")
    part = lambda x, unit: F.concat(x.cast("string"), F.lit(unit))
    return F.when(h > 0, F.concat(part(h, "h"), part(m, "m"), part(s % 60, "s"))).when(m > 0, F.concat(part(m, "m"), part(s % 60, "s"))).otherwise(part(s % 60, "s"))


def duration_of(seconds: float) -> str:
    s = int(seconds)
    h, m = s // 3600, s % 3600 // 60
    return (f"{h}h" if h else "") + (f"{m}m" if h or m else "") + f"{s % 60}s"


def prefixed(namespace: Column, prefix: str | None) -> Column:
    """A namespace behind the prefix that all namespaces of a project share."""
    return F.concat_ws("_", F.lit(prefix), namespace) if prefix else namespace


def prefixed_name(namespace: str, prefix: str | None) -> str:
    return f"{prefix}_{namespace}" if prefix else namespace


def quoted(name: str) -> str:
    """An SQL identifier in double quotes."""
    return '"' + name.replace('"', '""') + '"'


def quoted_table(name: str) -> str:
    schema, dot, table = name.partition(".")
    return f"{quoted(schema)}.{quoted(table)}" if dot else quoted(name)


def table_parts(name: str) -> tuple[str, str]:
    """(schema, table); a name without schema is in ``public``."""
    schema, dot, table = name.partition(".")
    return (schema, table) if dot else ("public", name)


VARIABLE = re.compile(r"\$\{([^}]+)\}")


def resolve(text: str, environment: Environment[str, str] | None = None) -> str:
    """``${NAME}`` replaced by the variable's value, by nothing if it is not set."""
    environment = os.environ if environment is None else environment
    return VARIABLE.sub(lambda m: environment.get(m[1], ""), text)


def resolve_required(text: str, environment: Environment[str, str] | None = None) -> str:
    """Like ``resolve``, but all variables must be set; the error names those that are not."""
    environment = os.environ if environment is None else environment
    missing = [name for name in VARIABLE.findall(text) if not environment.get(name)]
    if missing:
        raise KeyError(f"environment variables that are not set: {', '.join(dict.fromkeys(missing))}")
    return resolve(text, environment)
