"""Credentials of an arbiter: read on the driver only, never part of a message."""

from __future__ import annotations

import os
from pathlib import Path

REQUIRED = ("endpoint", "deployment", "api_key")


def find_file(given: str | None = None, variable: str = "SHELFSPARK_CREDENTIALS", defaults: tuple[str, ...] = ("credentials.yaml",)) -> str | None:
    """The path given, else the variable's, else the first default that exists."""
    if given:
        return given
    if os.environ.get(variable):
        return os.environ[variable]
    return next((d for d in defaults if Path(d).exists()), None)


def load(path: str) -> dict[str, str]:
    """Flat ``key: value`` lines; the required keys must be there and not blank. Errors name keys, not values."""
    try:
        text = Path(path).read_text(encoding="utf-8")
    except OSError:
        raise ValueError("the credentials file cannot be read") from None
    out: dict[str, str] = {}
    for line in text.splitlines():
        if line.strip() and not line.lstrip().startswith("#"):
            key, colon, value = line.partition(":")
            if not colon:
                raise ValueError("the credentials file has a line that is no 'key: value'")
            out[key.strip()] = value.strip().strip("'\"")
    if missing := [k for k in REQUIRED if not out.get(k)]:
        raise ValueError(f"the credentials file lacks {', '.join(missing)}")
    return out
