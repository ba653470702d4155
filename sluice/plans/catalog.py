"""The catalogue: every core query with its oracle SQL, by name."""

from __future__ import annotations

import importlib
from collections.abc import Callable

#: Modules of this package that define QUERIES (name -> function) and ORACLES (name -> SQL).
FAMILIES = ("scalars", "merges", "linking", "reports", "papers", "holdings", "layouts")


def _collect(attribute: str) -> dict:
    out: dict = {}
    for family in FAMILIES:
        part = getattr(importlib.import_module(f"sluice.plans.{family}"), attribute)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"query names defined twice: {sorted(clash)}")
        out.update(part)
    return out


def queries() -> dict[str, Callable]:
    return _collect("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _collect("ORACLES")
