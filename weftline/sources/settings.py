"""Settings from the environment, and from a file of ``NAME=value`` lines where the environment has none."""

from __future__ import annotations

import os
import re

_LINE = re.compile(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$")


def read_settings(path: str = ".env") -> dict[str, str]:
    """The names and values of a settings file; comments and other lines are skipped, a missing file is empty."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        found = [m.groups() for m in map(_LINE.fullmatch, f.read().splitlines()) if m]
    return {k: v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'" else v for k, v in found}


def setting(name: str, path: str = ".env", required: bool = True) -> str | None:
    """A setting of the environment or else the file; a missing one raises if it is required."""
    value = os.environ.get(name) or read_settings(path).get(name)
    if required and not value:
        raise KeyError(f"{name} is set neither in the environment nor in {path}")
    return value or None
