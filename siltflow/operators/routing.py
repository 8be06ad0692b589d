"""Which table a topic's records go to."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from siltflow.functions.redact import redact, redact_error

# The template's tokens, and what an identifier part may hold.
TOKEN = re.compile(r"\$\{topic(?:\[(\d+)\])?\}")
IDENTIFIER = re.compile(r"[A-Za-z0-9_]+")
MAX_IDENTIFIER = 255
OVERRIDE = re.compile(r"[^:\s]+\s*:\s*[^.:\s]+\.[^.:\s]+\.[^.:\s]+")


class RoutingError(ValueError):
    """A topic that no table can be named for."""


def parse_overrides(entries: list[str] | None) -> dict[str, str]:
    """{topic: table} of entries '<topic>:<catalog>.<schema>.<table>'; topics may stand once."""
    out: dict[str, str] = {}
    for e in entries or []:
        e = e.strip()
        if not OVERRIDE.fullmatch(e):
            raise ValueError(f"{e!r}: each entry must be '<topic>:<catalog>.<schema>.<table>'")
        topic, _, name = e.partition(":")
        if topic.strip() in out:
            raise ValueError(f"{e!r}: topic {topic.strip()!r} stands twice")
        out[topic.strip()] = name.strip()
    return out


def _part(value: str, topic: str) -> str:
    if len(value) > MAX_IDENTIFIER:
        raise RoutingError(f"topic {topic[:80]!r} gives a name part of {len(value)} characters, over {MAX_IDENTIFIER}")
    if not IDENTIFIER.fullmatch(value):
        # never folded to another character: two topics could then share a table
        raise RoutingError(f"topic {topic!r}: {value!r} can't be part of a table name (letters A to Z, digits and _ only)")
    return value


def render(template: str, topic: str) -> str:
    parts = topic.split(".")

    def fill(m: re.Match) -> str:
        if m[1] is None:
            return _part(topic, topic)
        if len(m[1]) > 9 or int(m[1]) >= len(parts):
            raise RoutingError(f"the template wants segment {m[1]} of topic {topic!r}, which has {len(parts)}")
        return _part(parts[int(m[1])], topic)

    return TOKEN.sub(fill, template)


def table_name(template: str, overrides: dict[str, str], topic: str) -> str:
    """The three-part table name of a topic: its override, or the filled template."""
    name = overrides.get(topic) or render(template, topic)
    parts = name.split(".")
    if len(parts) != 3 or not all(parts):
        raise RoutingError(f"topic {topic!r} gives {name!r}, which isn't <catalog>.<schema>.<table>")
    return name


@dataclass(frozen=True)
class Target:
    """A resolved table: its name, place and (non-secret) file-system settings."""

    name: str
    path: str
    table_id: str | None = None
    partition_columns: tuple[str, ...] = ()
    storage_conf: dict[str, str] = field(default_factory=dict)


class Catalog:
    """Tables below one root folder: <root>/<catalog>/<schema>/<table>."""

    def __init__(self, root: str, partition_columns: tuple[str, ...] = ()):
        self.root, self.partition_columns = root.rstrip("/"), partition_columns

    def resolve(self, name: str, schema=None) -> Target:
        """The table's place; a table is made by its first commit, so a schema changes nothing."""
        try:
            return Target(name, "/".join([self.root, *(_part(p, name) for p in name.split("."))]), partition_columns=self.partition_columns)
        except Exception as error:
            raise RoutingError(f"table {redact(name)} can't be resolved: {redact_error(error)}") from None

    def add_columns(self, name: str, schema, names: list[str]) -> None:
        """Nothing to tell anyone: the table's own log holds its columns."""
