"""Tokens and scoped storage secrets. No network here: minters are given a way to post forms."""

from __future__ import annotations

import base64
import threading
import time
from collections import OrderedDict
from collections.abc import Callable
from typing import NamedTuple, Protocol

from siltflow.functions.redact import redact_error

DEFAULT_TTL_S = 3600


class Token(NamedTuple):
    value: str
    ttl_s: int


class Minter(Protocol):
    def mint(self) -> Token: ...


#: post(url, headers, form) -> the JSON answer as a dict
Post = Callable[[str, dict[str, str], dict[str, str]], dict]


def _token(answer: dict) -> Token:
    if not answer.get("access_token"):
        raise PermissionError("the token endpoint gave no access_token")
    return Token(answer["access_token"], int(answer.get("expires_in") or DEFAULT_TTL_S))


class WorkspaceMinter:
    """Client credentials against a workspace's own token endpoint."""

    def __init__(self, url: str, client_id: str, client_secret: str, post: Post):
        self.url, self.post = url.rstrip("/") + "/oidc/v1/token", post
        self._basic = base64.b64encode(f"{client_id}:{client_secret}".encode()).decode()

    def mint(self) -> Token:
        return _token(self.post(self.url, {"Authorization": f"Basic {self._basic}"}, {"grant_type": "client_credentials", "scope": "all-apis"}))


class EntraMinter:
    """Client credentials against a tenant's token endpoint, for a fixed resource."""

    def __init__(self, tenant_id: str, client_id: str, client_secret: str, scope: str, post: Post, host: str = "https://login.microsoftonline.com"):
        self.url, self.post = f"{host}/{tenant_id}/oauth2/v2.0/token", post
        self._form = {"grant_type": "client_credentials", "client_id": client_id, "client_secret": client_secret, "scope": scope}

    def mint(self) -> Token:
        return _token(self.post(self.url, {}, dict(self._form)))


class Refreshing:
    """A token that is renewed at 80 % of its life, by one caller at a time; a failed renewal is borne while the token lasts."""

    def __init__(self, minter: Minter, clock: Callable[[], float] = time.monotonic, share: float = 0.8, cushion_s: float = 60):
        self.minter, self.clock, self.share, self.cushion_s = minter, clock, share, cushion_s
        self._lock = threading.Lock()
        self._token: str | None = None
        self._renew_at = self._ends_at = float("-inf")

    def __call__(self) -> str:
        if self._token is not None and self.clock() < self._renew_at:
            return self._token
        with self._lock:
            now = self.clock()
            if self._token is None or now >= self._renew_at:
                try:
                    value, ttl = self.minter.mint()
                except Exception as error:
                    if self._token is None or now >= self._ends_at:
                        raise PermissionError(f"no token: {redact_error(error)}") from None
                    self._renew_at = min(self._ends_at, now + 1)
                else:
                    self._token, self._ends_at = value, now + ttl
                    self._renew_at = now + max(0.0, min(ttl * self.share, ttl - self.cushion_s))
            return self._token


class ScopedSecrets:
    """Storage secrets by host and path; the longest path prefix wins. At most `limit` paths a host."""

    def __init__(self, limit: int = 1024):
        self.limit = limit
        self._hosts: dict[str, OrderedDict[str, bytearray]] = {}
        self._lock = threading.Lock()

    @staticmethod
    def _key(container: str | None, path: str) -> str:
        return f"{container or ''}/{path.strip('/')}".rstrip("/")

    @staticmethod
    def _wipe(secret: bytearray) -> None:
        secret[:] = bytes(len(secret))

    def put(self, host: str, container: str | None, path: str, secret: str) -> None:
        with self._lock:
            own = self._hosts.setdefault(host.lower(), OrderedDict())
            key = self._key(container, path)
            if key in own:
                self._wipe(own.pop(key))
            own[key] = bytearray(secret.encode())
            while len(own) > self.limit:
                self._wipe(own.popitem(last=False)[1])

    def _of_host(self, host: str) -> OrderedDict[str, bytearray] | None:
        host = host.lower()
        if host in self._hosts or "." in host:
            return self._hosts.get(host)
        found = [v for k, v in self._hosts.items() if k.partition(".")[0] == host]
        return found[0] if len(found) == 1 else None  # a short name must be unambiguous

    def get(self, host: str, container: str | None, path: str) -> str | None:
        with self._lock:
            own = self._of_host(host)
            key = self._key(container, path)
            best = max((p for p in own or () if key == p or key.startswith(p + "/")), key=len, default=None)
            if best is None:
                return None
            own.move_to_end(best)
            return own[best].decode()


def storage_conf(location: str, secret: str | None, store: ScopedSecrets, provider: str) -> dict[str, str]:
    """File-system settings of a table's place; the secret goes to the store, not into the settings."""
    from urllib.parse import urlsplit

    url = urlsplit(location)
    if not secret or not url.hostname:
        return {}
    host = url.hostname.lower()
    store.put(host, url.username, url.path, secret)
    return {f"fs.azure.account.auth.type.{host}": "SAS", f"fs.azure.sas.token.provider.type.{host}": provider, f"fs.azure.account.hns.enabled.{host}": "true"}
