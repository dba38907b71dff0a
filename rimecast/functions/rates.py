"""Rates of work."""

from __future__ import annotations


def columns_per_second(active: int, seconds: float) -> float:
    """Active columns per second; 0 if no time was measured."""
    return active / seconds if seconds > 0 else 0.0
