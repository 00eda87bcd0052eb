"""All registered queries by key."""

from __future__ import annotations

from .base import Check
from . import features, joins, layouts, learn, pricing, reports, stream, tables


def all_checks() -> dict[str, Check]:
    out: dict[str, Check] = {}
    for module in (tables, joins, features, pricing, reports, learn, stream, layouts):
        for check in module.CHECKS:
            if check.key in out:
                raise ValueError(f"key {check.key} is registered twice")
            out[check.key] = check
    return out
