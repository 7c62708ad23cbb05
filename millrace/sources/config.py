"""Configuration: defaults, loading from YAML, references to environment variables, validation."""

from __future__ import annotations

import os
import re
from copy import deepcopy

from ..functions.redact import is_plaintext_password, is_sensitive_name

#: The defaults of every setting.
DEFAULTS: dict = {
    "app": {"name": "millrace", "log_level": "info"},
    "source": {"type": "mysql", "mysql": {"port": 3306}, "kafka": {}, "postgresql": {"port": 5432}, "rest": {}, "file": {"format": "json"}},
    "storage": {
        "type": "local",
        "local": {"base_path": "./data-lake", "partition_strategy": "date", "file_format": "json", "compression": "none", "max_file_size_mb": 100, "max_records_per_file": 10000},
    },
    "schema": {"compatibility": "backward"},
    "checkpoint": {"storage_path": "./metadata/checkpoint.json", "save_interval_sec": 10},
    "processing": {"batch_size": 100, "worker_count": 4, "filters": [], "transforms": []},
    "retry": {"max_retries": 3, "initial_interval_ms": 100, "max_interval_ms": 10000},
}
FORMATS, CODECS, STRATEGIES = ("json", "csv", "parquet"), ("none", "snappy", "gzip", "zstd"), ("date", "hour", "none")

#: What each kind of source cannot do without.
_NEEDED = {"mysql": ("host", "user", "server_id"), "kafka": ("brokers",), "postgresql": ("host",), "rest": ("base_url",), "file": ("path", "image_schema")}


def _merged(base: dict, over: dict) -> dict:
    out = deepcopy(base)
    for key, value in over.items():
        out[key] = _merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def _resolved(value: object, env: dict[str, str]) -> object:
    if isinstance(value, dict):
        return {k: _resolved(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [_resolved(v, env) for v in value]
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)\}", lambda m: env.get(m[1], ""), value)
    return value


def validate(config: dict) -> None:
    kind = config["source"]["type"]
    if kind not in _NEEDED:
        raise ValueError(f"unsupported source type: {kind}")
    for name in _NEEDED[kind]:
        if not config["source"].get(kind, {}).get(name):
            raise ValueError(f"{kind} {name} is required")
    local = config["storage"]["local"]
    if config["storage"]["type"] != "local":
        raise ValueError(f"unsupported storage type: {config['storage']['type']}")
    for name, allowed in (("file_format", FORMATS), ("compression", CODECS), ("partition_strategy", STRATEGIES)):
        if local[name] not in allowed:
            raise ValueError(f"unsupported {name.replace('_', ' ')}: {local[name]}")


def from_dict(settings: dict, env: dict[str, str] | None = None) -> dict:
    """Settings over the defaults, `${NAME}` replaced from the environment, validated."""
    config = _resolved(_merged(DEFAULTS, settings), dict(os.environ) if env is None else env)
    validate(config)
    return config


def load(path: str) -> dict:
    import yaml  # only files need it

    with open(path) as f:
        return from_dict(yaml.safe_load(f) or {})


def plaintext_passwords(settings: dict, prefix: str = "") -> list[str]:
    """Paths of sensitive settings that hold their value itself."""
    found = []
    for key, value in settings.items():
        path = f"{prefix}{key}"
        if isinstance(value, dict):
            found += plaintext_passwords(value, f"{path}.")
        elif isinstance(value, str) and is_sensitive_name(key) and is_plaintext_password(value):
            found.append(path)
    return sorted(found)
