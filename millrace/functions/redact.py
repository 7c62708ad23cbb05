"""Redaction of secrets in values and by names of fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK, REDACTED = "******", "[REDACTED]"

#: Parts of the names of sensitive fields.
SENSITIVE = ("password", "secret", "token", "key", "credential", "auth", "passwd", "private_key", "api_key", "access_key", "secret_key")

#: What counts as a secret in a value, in the order of replacement.
PATTERNS = (
    r"(?i)(password|passwd|pwd)\s*[=:]\s*\S+",
    r"(?i)(secret|token|key)\s*[=:]\s*\S+",
    r"(?i)bearer\s+[a-zA-Z0-9\-._~+/]+=*",
    r"(?i)basic\s+[a-zA-Z0-9+/]+=*",
)


def redact(text: Column) -> Column:
    for pattern in PATTERNS:
        text = F.regexp_replace(text, pattern, REDACTED)
    return text


def is_sensitive(name: Column) -> Column:
    return F.lower(name).rlike("|".join(map(re.escape, SENSITIVE)))


def is_sensitive_name(name: str) -> bool:
    return any(part in name.lower() for part in SENSITIVE)


def mask_fields(fields: Column) -> Column:
    """A map of texts with the values of sensitive names masked."""
    return F.transform_values(fields, lambda k, v: F.when(is_sensitive(k), F.lit(MASK)).otherwise(v))


def is_plaintext_password(value: str | None) -> bool:
    """Not empty and not a reference `${NAME}`."""
    return bool(value) and not (value.startswith("${") and value.endswith("}"))
