"""Masking of secrets, for Python messages and for columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a secret, in the order in which it is masked. The groups named
# `keep` stay. The patterns work alike in Python and in Spark's regexp_replace.
MASK = "<redacted>"
RULES = (
    (r"(?i)abfss?://[^\s\"'<]+", "abfss://", False),
    (r"(?i)(sig|se|st|skoid|sktid|sks|ske|skt|skv|spr|srt|ss|sp|sr|sv|sdd)=[^&\s\"']+", "=", True),
    (r"(?i)(\"?sas_token\"?\s*[:=]\s*\"?)[^\"&\s,}]+", "", True),
    (r"(?i)(bearer\s+)[A-Za-z0-9._\-]+", "", True),
)
MAX_CAUSES = 10


def redact(text: str | None) -> str | None:
    if text is None:
        return None
    for pattern, after, keep in RULES:
        text = re.sub(pattern, (r"\1" if keep else "") + after + MASK, text)
    return text


def redact_column(col: Column | str) -> Column:
    out = F.col(col) if isinstance(col, str) else col
    for pattern, after, keep in RULES:
        out = F.regexp_replace(out, pattern, ("$1" if keep else "") + after + MASK)
    return out


def redact_error(error: BaseException | None) -> str | None:
    """The messages of an error and its causes, masked, at most ten."""
    if error is None:
        return None
    said, seen = [], set()
    while error is not None and id(error) not in seen and len(said) < MAX_CAUSES:
        seen.add(id(error))
        said.append(redact(f"{type(error).__name__}: {error}"))
        error = error.__cause__ or (None if error.__suppress_context__ else error.__context__)
    return "; caused by: ".join(said)


def _chain(error: BaseException):
    seen = set()
    while error is not None and id(error) not in seen:
        seen.add(id(error))
        yield str(error).lower()
        error = error.__cause__ or error.__context__


def is_auth_failure(error: BaseException) -> bool:
    """Whether retrying is pointless since the credentials were refused."""
    signs = ("401", "unauthorized", "token is expired", "invalid_client")
    return any(s in m for m in _chain(error) for s in signs)


def is_already_exists(error: BaseException) -> bool:
    signs = ("already exists", "fields_already_exist")
    return any(s in m for m in _chain(error) for s in signs)
