"""Parameters of a run and their validation."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from ..functions import constants as C


def members_of(model: str) -> tuple[str, ...]:
    if model not in C.MODELS:
        raise ValueError(f"unknown model {model!r}; known are {', '.join(sorted(C.MODELS))}")
    return tuple(f"{i:03d}" for i in range(C.MODELS[model][0]))


def parse_members(text: str, model: str) -> tuple[str, ...]:
    """``all``, or three-digit members of the model separated by commas; repeats count once."""
    known = members_of(model)
    if text == "all":
        return known
    asked = tuple(dict.fromkeys(x.strip() for x in text.split(",") if x.strip()))
    if not asked:
        raise ValueError("give all, or members like 000,001")
    for problem, bad in (("not a member", [m for m in asked if not re.fullmatch(r"\d{3}", m)]), (f"not in {model}", [m for m in asked if m not in known])):
        if bad:
            raise ValueError(f"{problem}: {', '.join(bad)}")
    return asked


@dataclass(frozen=True)
class RunConfig:
    """A validated run: ``workers`` members at a time; ``chunk_size`` and ``prefetch`` are accepted for compatible calls, Spark schedules."""

    model: str
    members: tuple[str, ...] | None = None
    max_step: int | None = None
    threshold_mm: float = 0.0
    cutoff_m: float = C.VERTICAL_CUTOFF
    chunk_size: int = 2
    workers: int = 4
    prefetch: bool = True
    full_levels: int = C.FULL_LEVELS

    def __post_init__(self):
        known = members_of(self.model)
        members = known if self.members is None else tuple(dict.fromkeys(self.members))
        if not members:
            raise ValueError("at least one member is needed")
        if bad := [m for m in members if m not in known]:
            raise ValueError(f"not in {self.model}: {', '.join(bad)}")
        object.__setattr__(self, "members", members)
        object.__setattr__(self, "max_step", C.MODELS[self.model][1] if self.max_step is None else self.max_step)
        if self.max_step < 0:
            raise ValueError(f"max_step must not be negative, got {self.max_step}")
        for name in ("chunk_size", "workers", "full_levels"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive, got {getattr(self, name)}")
        if not math.isfinite(self.threshold_mm) or self.threshold_mm < 0:
            raise ValueError(f"the precipitation threshold must be finite and not negative, got {self.threshold_mm}")
        if not math.isfinite(self.cutoff_m):
            raise ValueError(f"the vertical cutoff must be finite, got {self.cutoff_m}")
