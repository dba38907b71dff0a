"""Search path of an encoder's definition files, for executors that write messages.

An explicit override comes first, then folders of installed packages, then fallbacks; an overlay stands before all of them. Folders
that don't exist are left out, repeated ones count once, and doing it twice changes nothing.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Mapping


def ordered_once(items: Iterable[str]) -> list[str]:
    """Distinct items in their order, without empty ones."""
    return list(dict.fromkeys(x for x in items if x))


def search_path(current: str | None, *, override: str | None = None, installed: Iterable[str] = (), fallbacks: Iterable[str] = (), overlay: str | None = None, exists: Callable[[str], bool] = os.path.isdir) -> str | None:
    """The path to set, folders joined by ':'; None if there is none."""
    base = override.split(":") if override else [*installed, *fallbacks]
    there = [x for x in ordered_once([overlay or "", *base]) if exists(x)]
    found = ordered_once([*there, *(current or "").split(":")])
    return ":".join(found) or None


def executor_settings(variable: str, path: str | None) -> Mapping[str, str]:
    """Settings for the session's builder that give executors the path."""
    return {f"spark.executorEnv.{variable}": path} if path else {}
