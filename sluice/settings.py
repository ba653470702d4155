"""Settings from the environment: what is still a template's placeholder counts as unset; portals are
swept only with a permission on record.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping

#: What templates leave where a value belongs.
PLACEHOLDER = re.compile(r"(?i)^\s*(?:|<.*>|\[.*\]|\{\{.*\}\}|x{3,}|\.{3,}|(?:your|my|replace|insert|enter|put|paste)[-_ ].*|change[-_ ]?me|todo|tbd|none|null|example|placeholder|sk-or-(?:\.\.\.|xxx.*|your.*))\s*$")


def setting(name: str, default: str | None = None, placeholders: tuple[str, ...] = (), env: Mapping[str, str] | None = None) -> str | None:
    """A setting, or default where it is unset, blank, or a placeholder (of those in general use, or one given)."""
    value = (os.environ if env is None else env).get(name)
    return default if value is None or value in placeholders or PLACEHOLDER.match(value) else value


def portals(path: str) -> list[dict]:
    """The portals of a JSON file that may be swept: enabled, and with the permission that says so. One that is enabled
    without is an error, not a portal to skip: somebody meant it to run."""
    with open(path) as f:
        listed = json.load(f)
    bare = [p.get("slug") for p in listed if p.get("enabled") and not p.get("permission")]
    if bare:
        raise PermissionError(f"enabled without a permission on record: {', '.join(map(str, bare))}")
    return [p for p in listed if p.get("enabled")]
