"""Settings of an ingestion, checked as a whole before anything runs."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from urllib.parse import urlsplit

from siltflow.functions.redact import redact
from siltflow.operators.evolution import Evolution
from siltflow.operators.routing import parse_overrides

AUTH_NEEDS = {"pat": ("auth_token",), "oauth-m2m": ("auth_client_id", "auth_client_secret"), "azure-entra": ("auth_tenant_id", "auth_client_id", "auth_client_secret")}


class ConfigError(ValueError):
    """A setting, or a combination of settings, that can't be used."""


@dataclass(frozen=True)
class IngestConfig:
    root: str = ""
    name: str = "siltflow"
    table_name_format: str = "main.ingestion.${topic}"
    topic_to_table: dict[str, str] = field(default_factory=dict)
    partition_columns: tuple[str, ...] = ()
    flush_size: int = 500
    flush_bytes: int = 0
    flush_interval_ms: int = 5000
    flush_concurrency: int = 1
    max_buffered: int = 1_000_000
    auto_create_tables: bool = True
    schema_evolution: Evolution = Evolution.NONE
    dead_letters: bool = True
    commit_per_partition: bool = False
    catalog_url: str = ""
    auth_type: str = "pat"
    auth_token: str = field(default="", repr=False)
    auth_client_id: str = ""
    auth_client_secret: str = field(default="", repr=False)
    auth_tenant_id: str = ""

    def __post_init__(self):
        if max(self.flush_size, self.flush_bytes, self.flush_interval_ms) <= 0:
            raise ConfigError("one of flush_size, flush_bytes and flush_interval_ms must be over 0: with none, nothing is ever committed")
        if self.flush_concurrency < 1:
            raise ConfigError("flush_concurrency must be 1 or more")
        if self.auth_type not in AUTH_NEEDS:
            raise ConfigError(f"auth_type must be one of {', '.join(AUTH_NEEDS)}")
        if self.catalog_url:
            url = urlsplit(self.catalog_url.strip())
            if url.scheme.lower() != "https" or not url.hostname:
                raise ConfigError(f"catalog_url must be an https:// URL with a host, not {redact(self.catalog_url)}")
            for k in AUTH_NEEDS[self.auth_type]:
                if not getattr(self, k).strip():
                    raise ConfigError(f"auth_type {self.auth_type} needs {k}")

    @classmethod
    def of(cls, settings: dict[str, str]) -> IngestConfig:
        """From text settings, named as the fields; dots may stand for underscores."""
        known = {f.name: f for f in fields(cls)}
        out: dict = {}
        for key, text in settings.items():
            k = key.replace(".", "_")
            if k not in known:
                raise ConfigError(f"unknown setting {key}")
            default = getattr(cls(), k)
            try:
                if k == "topic_to_table":
                    out[k] = parse_overrides([x for x in text.split(",") if x.strip()]) if isinstance(text, str) else dict(text)
                elif k == "schema_evolution":
                    if str(text).strip().lower() not in {e.value for e in Evolution}:
                        raise ValueError("must be none, add or merge")
                    out[k] = Evolution.of(text)
                elif isinstance(default, tuple):
                    out[k] = tuple(x.strip() for x in text.split(",") if x.strip())
                elif isinstance(default, bool):
                    if str(text).strip().lower() not in ("true", "false"):
                        raise ValueError("must be true or false")
                    out[k] = str(text).strip().lower() == "true"
                else:
                    out[k] = type(default)(text)
            except ValueError as error:
                raise ConfigError(f"{key}: {redact(str(error))}") from None
        return cls(**out)

    def for_tasks(self, n: int) -> list[IngestConfig]:
        """The settings of n parallel ingestions: they are the same."""
        return [self] * n
