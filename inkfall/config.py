"""Settings of a run: defaults, a file's and the environment's, laid over each other."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Mapping
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from typing import Any

# Output tokens of each chunk, for five and for three chunks, and for any other number.
CHUNK_TOKENS = {5: (3500, 3000, 5000, 3500, 2500), 3: (4096, 5000, 8192)}
OTHER_TOKENS = 3500
#: Seconds before the first retry, and the most that is waited.
FIRST_DELAY, MOST_DELAY = 1.0, 30.0


def laid_over(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """``base`` with what ``over`` says, mappings within mappings too."""
    out = dict(base)
    for key, value in over.items():
        old = out.get(key)
        out[key] = laid_over(old, value) if isinstance(old, Mapping) and isinstance(value, Mapping) else value
    return out


def load(path: str | None, defaults: Mapping[str, Any], read: Callable[[str], Any] = json.loads, environment: str = "") -> dict[str, Any]:
    """Defaults, over them the file's settings, over them variables named ``<environment>_<KEY>``.

    ``read`` parses the file's text (JSON; give another for other formats). A top-level key that the defaults don't have is an error.
    """
    given = {}
    if path:
        with open(path, encoding="utf-8") as f:
            given = read(f.read()) or {}
    unknown = sorted(set(given) - set(defaults))
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    out = laid_over(defaults, given)
    for key in defaults:
        value = os.environ.get(f"{environment}_{key}".upper()) if environment else None
        if value is not None:
            out[key] = type(defaults[key])(value) if isinstance(defaults[key], int | float | str) and not isinstance(defaults[key], bool) else json.loads(value)
    return out


def fingerprint(settings: Mapping[str, Any], *sections: str) -> str:
    """SHA-256 of the sections (all if none is named) as JSON with sorted keys."""
    part = {s: settings.get(s) for s in sections} if sections else dict(settings)
    return hashlib.sha256(json.dumps(part, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def chunk_tokens(chunk: int, chunks: int) -> int:
    """Output tokens of a chunk (from 1) of so many."""
    sizes = CHUNK_TOKENS.get(chunks, ())
    return sizes[chunk - 1] if 0 < chunk <= len(sizes) else OTHER_TOKENS


def retry_delay(attempt: int, after: str | None = None, now: datetime | None = None) -> float:
    """Seconds before a retry: what the server says (seconds or a date), else doubled with each attempt; MOST_DELAY at most."""
    if after and after.strip():
        try:
            seconds = float(after)
        except ValueError:
            try:
                when = parsedate_to_datetime(after)
                when = when if when.tzinfo else when.replace(tzinfo=UTC)
                seconds = (when - (now or datetime.now(UTC))).total_seconds()
            except ValueError:
                seconds = None
        if seconds is not None:
            return min(max(seconds, 0.0), MOST_DELAY)
    return min(FIRST_DELAY * 2 ** (attempt - 1), MOST_DELAY)
