"""Single columns and small grids in memory, on the array kernel (no Spark session)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ..functions import constants as C
from . import kernel
from .quality import DataQualityError


@dataclass(frozen=True)
class ColumnResult:
    """Ice probabilities and type probabilities (strict rule, and consistent with precipitation) and the code."""

    pure_ice: float
    ice: float
    pure: dict[str, float]
    probabilities: dict[str, float]
    code: int


def _one_dimension(name: str, values) -> np.ndarray:
    a = np.asarray(values, np.float64)
    if a.ndim != 1:
        raise ValueError(f"{name} must have one dimension, got shape {a.shape}")
    return a


def diagnose_thermodynamics(temperature_c, wet_bulb_c, rh_ice_pct, height_m, total_precip_mm: float, ground_temperature_c: float, *, threshold: float = 0.0) -> ColumnResult:
    """One column whose thermodynamics are known, top first."""
    given = {"temperature_c": temperature_c, "wet_bulb_c": wet_bulb_c, "rh_ice_pct": rh_ice_pct, "height_m": height_m}
    tc, tw, rh, h = (_one_dimension(k, v)[:, None] for k, v in given.items())
    if len({len(x) for x in (tc, tw, rh, h)}) != 1:
        raise ValueError("all levels must have the same number")
    deep, ice, seen, relaxed = kernel.ice_state(rh, tc, h)
    n, e = kernel.areas(tw, h)
    ground = np.array([float(ground_temperature_c)])
    zero = np.zeros((len(C.TYPES), 1))
    pure = kernel.probabilities(n, e, ice, tw[-1], ground) if deep[0] else zero
    used, mixed = ice, pure
    if total_precip_mm <= threshold:
        mixed = zero
    elif pure.sum() == 0:
        used, mixed = relaxed, kernel.probabilities(n, e, relaxed, tw[-1], ground) if seen[0] else zero
    named = lambda grid: {k: float(v) for k, v in zip(C.TYPES, grid[:, 0], strict=True)}
    return ColumnResult(float(ice[0]), float(used[0]), named(pure), named(mixed), int(kernel.categories(mixed)[0]))


def diagnose_column(temperature_k, pressure_pa, specific_humidity, height_m, total_precip_mm: float, ground_temperature_c: float, *, threshold: float = 0.0) -> ColumnResult:
    """One raw column, top first."""
    t, p, q = (_one_dimension(k, v) for k, v in (("temperature_k", temperature_k), ("pressure_pa", pressure_pa), ("specific_humidity", specific_humidity)))
    tc, rh, tw = kernel.thermodynamics(t, q, p)
    return diagnose_thermodynamics(tc, tw, rh, height_m, total_precip_mm, ground_temperature_c, threshold=threshold)


@dataclass(frozen=True)
class GridResult:
    """As ``ColumnResult``, with grids in place of numbers."""

    pure_ice: np.ndarray
    ice: np.ndarray
    pure: dict[str, np.ndarray]
    probabilities: dict[str, np.ndarray]
    code: np.ndarray


def _grid(temperature_k, pressure_pa, specific_humidity, half_level_height_m, total_precip_mm, ground_temperature_c):
    """Profiles as levels by cells, full-level heights, surface fields and the grid's shape."""
    t, p, q, half = (np.asarray(x, np.float64) for x in (temperature_k, pressure_pa, specific_humidity, half_level_height_m))
    rain, ground = np.asarray(total_precip_mm, np.float64), np.asarray(ground_temperature_c, np.float64)
    if t.ndim < 2 or not t.shape == p.shape == q.shape or half.shape != (t.shape[0] + 1, *t.shape[1:]) or not rain.shape == ground.shape == t.shape[1:]:
        raise ValueError("profiles need equal shapes (levels first), half levels one more level, surface fields none")
    t, p, q = (x.reshape(len(x), -1) for x in (t, p, q))
    half = half.reshape(len(half), -1)
    return t, p, q, 0.5 * (half[:-1] + half[1:]), rain.ravel(), ground.ravel(), rain.shape


def diagnose_grid_full(temperature_k, pressure_pa, specific_humidity, half_level_height_m, total_precip_mm, ground_temperature_c, *, threshold: float = 0.0) -> GridResult:
    """All diagnostics of every column, without a gate: arrays are levels by any horizontal shape."""
    t, p, q, h, rain, ground, shape = _grid(temperature_k, pressure_pa, specific_humidity, half_level_height_m, total_precip_mm, ground_temperature_c)
    tc, rh, tw = kernel.thermodynamics(t, q, p)
    deep, ice, seen, relaxed = kernel.ice_state(rh, tc, h)
    n, e = kernel.areas(tw, h)
    pure = np.where(deep, kernel.probabilities(n, e, ice, tw[-1], ground), 0.0)
    dry, total = rain <= threshold, pure.sum(axis=0)
    fall = ~dry & (total == 0)
    mixed = np.where(fall, np.where(seen, kernel.probabilities(n, e, relaxed, tw[-1], ground), 0.0), pure)
    mixed = np.where(dry, 0.0, mixed)
    named = lambda grid: {k: x.reshape(shape) for k, x in zip(C.TYPES, grid, strict=True)}
    return GridResult(ice.reshape(shape), np.where(fall, relaxed, ice).reshape(shape), named(pure), named(mixed), kernel.categories(mixed).reshape(shape))


def warm_up() -> None:
    """Diagnose the smallest grid, of two levels and one cell, so that what is loaded at first use is loaded."""
    diagnose_grid(np.full((2, 1), 270.0), np.full((2, 1), 8e4), np.full((2, 1), 0.002), np.array([[2000.0], [1000.0], [0.0]]), np.ones(1), -np.ones(1))


def diagnose_grid(temperature_k, pressure_pa, specific_humidity, half_level_height_m, total_precip_mm, ground_temperature_c, *, threshold: float = 0.0) -> tuple[np.ndarray, dict[str, int]]:
    """Codes (in the grid's shape) and quality counters; arrays are levels by any horizontal shape.

    Raises DataQualityError where a column that would be diagnosed holds undefined values.
    """
    t, p, q, h, rain, ground, shape = _grid(temperature_k, pressure_pa, specific_humidity, half_level_height_m, total_precip_mm, ground_temperature_c)
    rain_ok, ground_ok = np.isfinite(rain), np.isfinite(ground)
    whole = np.logical_and.reduce([np.isfinite(x).all(axis=0) for x in (t, p, q, h)])
    active = rain_ok & (np.where(rain_ok, rain, 0.0) > threshold)
    masks = (np.ones(len(rain), bool), active, ~rain_ok, ~ground_ok, ~whole, active & ~ground_ok, active & ~whole)
    counted = {k: int(m.sum()) for k, m in zip(C.QUALITY_COUNTERS, masks, strict=True)}
    for k in C.FATAL_COUNTERS:
        if counted[k]:
            raise DataQualityError(f"{k}: {counted[k]}")
    out = np.zeros(len(rain), np.int32)
    if active.any():
        out[active] = kernel.ptype(*(np.ascontiguousarray(x[:, active]) for x in (t, q, p, h)), ground[active])
    return out.reshape(shape), counted
