"""Rules in text: filters such as `age > 18` and transforms such as `mask:email:***`."""

from __future__ import annotations

import re

from .filters import Filter, column_filter
from .transforms import Transform, add_timestamp, mask_field

_FILTER = re.compile(r"\s*([A-Za-z_]\w*)\s*(==|!=|>=|<=|=|>|<)\s*(.+?)\s*")


def literal(text: str) -> object:
    """A quoted text, null, true, false or a number; else the bare text."""
    if len(text) >= 2 and text[0] == text[-1] and text[0] in "'\"":
        return text[1:-1]
    if text.lower() in ("null", "true", "false"):
        return {"null": None, "true": True, "false": False}[text.lower()]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def parse_filter(rule: str) -> Filter:
    found = _FILTER.fullmatch(rule)
    if not found:
        raise ValueError(f"not a filter rule: {rule!r}")
    return column_filter(found[1], found[2], literal(found[3]))


def parse_transform(rule: str) -> Transform:
    """`add_timestamp:field` or `mask:field:mask[:kept bytes]`."""
    kind, *rest = rule.split(":")
    if kind == "add_timestamp" and len(rest) == 1 and rest[0]:
        return add_timestamp(rest[0])
    if kind == "mask" and len(rest) in (2, 3) and rest[0]:
        return mask_field(rest[0], rest[1], int(rest[2]) if len(rest) == 3 else 0)
    raise ValueError(f"not a transform rule: {rule!r}")
