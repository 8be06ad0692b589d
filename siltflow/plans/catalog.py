"""A catalog client over a pluggable transport: tables, scoped credentials, statements."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import types as T

from siltflow.functions.redact import is_already_exists, redact, redact_error
from siltflow.functions.types import added_column_defs, column_defs
from siltflow.operators.routing import RoutingError, Target
from siltflow.plans.credentials import ScopedSecrets, storage_conf

#: send(method, path, body) -> (status, JSON answer)
Send = Callable[[str, str, dict | None], tuple[int, dict]]


class NotFound(LookupError):
    """The catalog has no such table."""


class CatalogError(RuntimeError):
    """The catalog refused; its answer is left out, as it may hold secrets."""


@dataclass(frozen=True)
class TableInfo:
    table_id: str
    location: str


class CatalogClient:
    def __init__(self, send: Send, api: str = "/api/2.1/catalog", wait: Callable[[float], None] = time.sleep):
        self.send, self.api, self.wait = send, api, wait

    def _ask(self, method: str, path: str, body: dict | None = None) -> dict:
        status, answer = self.send(method, path, body)
        if status == 404:
            raise NotFound(f"{method} {path}: 404")
        if status >= 300:
            raise CatalogError(f"{method} {path}: status {status}")
        return answer

    def get_table(self, name: str) -> TableInfo:
        """A table's id and place; NotFound if the catalog lacks it."""
        answer = self._ask("GET", f"{self.api}/tables/{name}")
        return TableInfo(answer["table_id"], answer["storage_location"])

    def credentials(self, table_id: str, operation: str = "READ_WRITE") -> dict:
        return self._ask("POST", f"{self.api}/temporary-table-credentials", {"table_id": table_id, "operation": operation})

    def execute(self, warehouse: str, statement: str, polls: int = 30, every_s: float = 2.0) -> None:
        """Runs a statement and waits until it has succeeded."""
        answer = self._ask("POST", "/api/2.0/sql/statements", {"warehouse_id": warehouse, "statement": statement, "wait_timeout": "50s"})
        for _ in range(polls):
            state = answer.get("status", {}).get("state")
            if state not in ("PENDING", "RUNNING"):
                break
            self.wait(every_s)
            answer = self._ask("GET", f"/api/2.0/sql/statements/{answer['statement_id']}")
        if (state := answer.get("status", {}).get("state")) != "SUCCEEDED":
            raise CatalogError(f"the statement didn't succeed (state={state})")


class StagedCommits:
    """Commits that a coordinator ratifies before they are published to the numbered log."""

    def __init__(self, storage, log: str):
        self.storage, self.log = storage, log
        self.highest_published = -1

    def stage(self, version: int, text: str, tag: str) -> str:
        name = f"{version:020d}.{tag}.json"
        if not self.storage.create(f"{self.log}/_staged/{name}", text):
            raise CatalogError(f"{name} is staged already")
        return name

    def ratify(self, version: int, name: str) -> bool:
        """Registers a staged commit at a version; the first one wins it."""
        return self.storage.create(f"{self.log}/_ratified/{version:020d}", name)

    def pending(self) -> list[tuple[int, str]]:
        """Ratified commits that aren't published, by version."""
        done = {n for n in self.storage.list(self.log) if len(n) == 25 and n.endswith(".json")}
        names = [n for n in self.storage.list(f"{self.log}/_ratified") if n.isdigit()]
        return [(int(n), self.storage.read(f"{self.log}/_ratified/{n}")) for n in sorted(names) if f"{n}.json" not in done]

    def publish(self) -> list[int]:
        """Copies pending commits to the numbered log; those that are there are skipped."""
        out = []
        for version, name in self.pending():
            if self.storage.create(f"{self.log}/{version:020d}.json", self.storage.read(f"{self.log}/_staged/{name}")):
                self.highest_published = max(self.highest_published, version)
                out.append(version)
        return out


class FakeCatalog:
    """A catalog in memory behind the same calls as a real one, for tests and queries: it knows only tables that were created."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.tables: dict[str, dict] = {}
        self.statements: list[str] = []
        self.calls: list[tuple[str, str, str]] = []

    def __call__(self, method: str, path: str, body: dict | None, token: str = "") -> tuple[int, dict]:
        self.calls.append((method, path, token))
        last = path.rsplit("/", 1)[-1]
        if "/tables/" in path:
            return (200, self.tables[last]) if last in self.tables else (404, {})
        if last == "temporary-table-credentials":
            return 200, {"sas_token": f"sig={body['table_id']}"}
        self.statements.append(body["statement"])
        if body["statement"].startswith("CREATE TABLE"):
            name = body["statement"].split("(")[0].removeprefix("CREATE TABLE IF NOT EXISTS ").replace("`", "").strip()
            self.tables.setdefault(name, {"table_id": f"id-{len(self.tables)}", "storage_location": f"{self.root}/{name.replace('.', '/')}"})
        return 200, {"statement_id": "s", "status": {"state": "SUCCEEDED"}}


class RemoteCatalog:
    """Tables that a catalog service knows: their places, vended secrets and file-system settings, and DDL for new ones and new columns."""

    def __init__(self, client: CatalogClient, secrets: ScopedSecrets, warehouse: str = "", provider: str = "", partition_columns: tuple[str, ...] = ()):
        self.client, self.secrets, self.warehouse, self.provider = client, secrets, warehouse, provider
        self.partition_columns = partition_columns

    def resolve(self, name: str, schema: T.StructType | None = None) -> Target:
        """The table; with a schema it is made first if the catalog lacks it."""
        try:
            try:
                info = self.client.get_table(name)
            except NotFound:
                if schema is None:
                    raise
                self._make(name, schema)
                info = self.client.get_table(name)
            secret = self.client.credentials(info.table_id).get("sas_token")
            conf = storage_conf(info.location, secret, self.secrets, self.provider)
            return Target(name, info.location, info.table_id, self.partition_columns, conf)
        except Exception as error:
            raise RoutingError(f"table {redact(name)} can't be resolved: {redact_error(error)}") from None

    def _make(self, name: str, schema: T.StructType) -> None:
        try:
            self.client.execute(self.warehouse, f"CREATE TABLE IF NOT EXISTS {_dotted(name)} ({column_defs(schema)})")
        except Exception as error:
            if not is_already_exists(error):
                raise

    def add_columns(self, name: str, schema: T.StructType, names: list[str]) -> None:
        try:
            self.client.execute(self.warehouse, f"ALTER TABLE {_dotted(name)} ADD COLUMNS ({added_column_defs(schema, names)})")
        except Exception as error:
            if not is_already_exists(error):  # another writer was first
                raise


def _dotted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def authorised(send: Callable[[str, str, dict | None, str], tuple[int, dict]], token: Callable[[], str]) -> Send:
    """A Send whose every request asks for the token of the moment."""
    return lambda method, path, body: send(method, path, body, token())
