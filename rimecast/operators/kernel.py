"""The column diagnostic over array columns: one pass down the levels for a whole Arrow batch.

A batch of columns becomes matrices of levels by columns. Layers and areas are followed in
running state (one vector operation per level and rule), so nothing is sorted or exchanged and
the work per column is linear in its levels. Undefined values are NaN here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..shipping import ship


def thermodynamics(t: np.ndarray, qv: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Temperature (deg C), humidity over ice (percent), wet bulb (deg C)."""
    with np.errstate(all="ignore"):
        tc = t - C.KELVIN
        dew = C.DEW_TEMPERATURE / np.log(C.DEW_PRESSURE * C.VAPOUR_RATIO / (qv * p))
        pressure = lambda x: C.ICE_VAPOUR_PA * np.exp(C.ICE_VAPOUR_RATE * (x - C.TRIPLE_POINT) / (x - C.ICE_VAPOUR_OFFSET))
        rh = pressure(dew) / pressure(t) * 100.0
        d = (dew - C.KELVIN) * 10.0
        s = tc * 10.0 - d
        z = d + C.WB_HALF_STEP * s * (C.WB_DEW_WEIGHT - d / C.WB_DEW_SCALE)
        tw = C.WB_TENTHS * (d + s / (1.0 + 10.0 * C.WB_PRESSURE_GROWTH * np.exp(C.WB_GROWTH_RATE * z / (C.WB_GROWTH_OFFSET + z)) / p))
    return tc, rh, tw


def _ice(coldest: np.ndarray) -> np.ndarray:
    x = np.where(np.isfinite(coldest), coldest, 0.0)
    poly = np.clip(np.polyval(C.ICE_POLYNOMIAL, x), 0.0, 100.0)
    return np.where(coldest <= C.ALL_ICE, 100.0, np.where(coldest >= C.NO_ICE, 0.0, poly))


def ice_state(rh: np.ndarray, tc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """generated, ice, relaxed_generated, relaxed_ice of each column."""
    n = rh.shape[1]
    moist = rh > C.RH_ICE_PRECIP
    strict, clear, lowest = np.full(n, np.inf), np.full(n, np.inf), np.full(n, np.inf)
    deep, any_clear, seen = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    top, bottom, coldest = h[0].copy(), h[0].copy(), tc[0].copy()

    def close(ends, wet):
        """Account for the layers that end here."""
        nonlocal strict, clear, lowest
        depth = top - bottom
        layer = ends & wet
        seen[layer] = any_clear[layer] = True
        lowest = np.where(layer, coldest, lowest)
        clear = np.where(layer, np.fmin(clear, coldest), clear)
        thick = layer & (depth > C.GENERATION_DEPTH)
        deep[thick] = True
        strict = np.where(thick, np.fmin(strict, coldest), strict)
        gap = ends & ~wet & (depth > C.SUBLIMATION_DEPTH)  # what is above it evaporates
        deep[gap] = any_clear[gap] = False
        strict, clear = np.where(gap, np.inf, strict), np.where(gap, np.inf, clear)

    for k in range(1, len(rh)):
        new = moist[k] != moist[k - 1]
        close(new, moist[k - 1])
        top = np.where(new, h[k], np.fmax(top, h[k]))
        bottom = np.where(new, h[k], np.fmin(bottom, h[k]))
        coldest = np.where(new, tc[k], np.fmin(coldest, tc[k]))
    close(np.ones(n, bool), moist[-1])
    return deep, np.where(deep, _ice(strict), 0.0), seen, np.where(seen, _ice(np.where(any_clear, clear, lowest)), 0.0)


def areas(tw: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of areas looked at and their energies from the surface up (3 by columns)."""
    n = tw.shape[1]
    sign = np.where(tw > 0, 1, np.where(tw < 0, -1, 0)).astype(np.int8)
    lead = np.zeros(n, np.int8)
    for k in range(len(sign)):  # the first sign there is
        lead = np.where(lead == 0, sign[k], lead)
    last = np.where(lead == 0, 1, lead)
    for k in range(len(sign)):
        sign[k] = last = np.where(sign[k] == 0, last, sign[k])
    e, count = np.zeros((3, n)), np.zeros(n, int)
    run, first = np.zeros(n), np.ones(n, bool)

    def close(ends):
        use = ends & ~first & (np.abs(run) >= C.LEAST_AREA)
        joins = use & (count > 0) & (np.sign(e[0]) == np.sign(run))
        e[0][joins] += run[joins]
        new = use & ~joins
        e[2][new], e[1][new], e[0][new] = e[1][new], e[0][new], run[new]
        count[new] += 1
        first[ends] = False

    for k in range(1, len(sign)):
        new = sign[k] != sign[k - 1]
        close(new)
        term = 0.5 * (tw[k - 1] + tw[k]) / C.KELVIN * (h[k - 1] - h[k]) * C.GRAVITY
        run = np.where(new, 0.0, run + np.where(np.isnan(term), 0.0, term))
    close(np.ones(n, bool))
    return np.minimum(count, np.where(tw[-1] < 0, 2, 3)), e


def probabilities(n: np.ndarray, e: np.ndarray, ice: np.ndarray, surface: np.ndarray, ground: np.ndarray) -> np.ndarray:
    """Types (in tie order) by columns, from areas, ice probability, surface wet bulb and ground temperature."""
    clip = lambda x: np.where(x < 0, 0.0, np.where(x > 100, 100.0, x))
    with np.errstate(all="ignore"):
        pellets = lambda r, m: clip(ice / 100 * clip(2.3 * r - 42.0 * np.log(m + 1.0) + 3.0))
        snowy = lambda rate, m: clip(ice / 100 * clip(1540.0 * np.exp(-rate * m)))

        def liquid(r, m):
            ramp = -2.1 * r + 0.2 * m + 458.0
            return clip((100 - ice) + ice / 100 * clip(np.where(m < 5, ramp * (0.2 * m), ramp)))

        cold, warm, icy, one = surface < 0, surface > 0, ground < C.GROUND_FREEZING, np.full(len(ice), C.SHALLOW_REFREEZING)
        zero, snow1, rain3 = np.zeros(len(ice)), snowy(0.29, e[0]), liquid(np.abs(e[1]), e[2])
        rain1, back, shallow = 100 - snow1, np.abs(e[0]), np.where(cold, liquid(one, e[0]), 0.0)
        by = {
            "freezing_rain": (zero, shallow, np.where(warm, 0.0, liquid(back, e[1])), shallow),
            "freezing_rain_on_ground": (zero, np.where(icy & ~cold, rain1, 0.0), zero, np.where(icy & ~cold, rain3, 0.0)),
            "ice_pellets": (zero, np.where(cold, pellets(one, e[0]), 0.0), pellets(back, e[1]), pellets(np.abs(e[1]), e[2])),
            "freezing_drizzle": (np.where(warm, 0.0, 100 - ice), zero, zero, zero),
            "snow": (ice, snow1, snowy(0.28, e[1]), snowy(0.28, e[2] + e[0])),
            "rain": (np.where(warm, 100 - ice, 0.0), np.where(cold, 0.0, rain1), zero, np.where(cold, 0.0, rain3)),
        }
        return np.stack([clip(np.choose(np.minimum(n, 3), by[name])) for name in C.TYPES])


def categories(grid: np.ndarray) -> np.ndarray:
    """Code of each column of probabilities; an undefined one never wins."""
    grid = np.where(np.isnan(grid), -np.inf, grid)
    best = grid.argmax(axis=0)
    return np.where(grid.max(axis=0) > 0, np.array(list(C.TYPES.values()))[best], 0).astype(np.int32)


def codes(n: np.ndarray, e: np.ndarray, ice: np.ndarray, surface: np.ndarray, ground: np.ndarray) -> np.ndarray:
    return categories(probabilities(n, e, ice, surface, ground))


def ptype(t: np.ndarray, qv: np.ndarray, p: np.ndarray, h: np.ndarray, ground: np.ndarray) -> np.ndarray:
    """Codes of wet columns; all matrices are levels by columns, top first."""
    tc, rh, tw = thermodynamics(t, qv, p)
    deep, ice, seen, relaxed = ice_state(rh, tc, h)
    n, e = areas(tw, h)
    pure = np.where(deep, codes(n, e, ice, tw[-1], ground), 0)
    return np.where(pure != 0, pure, np.where(seen, codes(n, e, relaxed, tw[-1], ground), 0)).astype(np.int32)


def _matrix(column) -> np.ndarray:
    """Levels by columns from a list column whose lists have equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.ascontiguousarray(flat.reshape(len(column), -1).T)


def categorical_arrays(columns: DataFrame, keys: list[str], *, threshold: float = 0.0) -> DataFrame:
    """(keys, ptype) from one row per column with arrays temperature_k, specific_humidity, pressure_pa,
    height_m (top first) and total_precip_mm, ground_temperature_c. Columns of a batch may differ in levels."""
    ship(columns.sparkSession)
    names = ["temperature_k", "specific_humidity", "pressure_pa", "height_m"]

    def run(batches):
        for b in batches:
            rain = b.column("total_precip_mm").to_numpy(zero_copy_only=False).astype(np.float64)
            ground = b.column("ground_temperature_c").to_numpy(zero_copy_only=False).astype(np.float64)
            out = np.zeros(len(rain), np.int32)
            size = pa.compute.list_value_length(b.column(names[0])).to_numpy(zero_copy_only=False)
            wet = np.isfinite(rain) & (rain > threshold) & (size > 0)
            for n in np.unique(size[wet]):
                at = np.flatnonzero(wet & (size == n))
                part = b.take(pa.array(at))
                out[at] = ptype(*[_matrix(part.column(c)) for c in names], ground[at])
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], pa.array(out)], [*keys, "ptype"])

    head = ", ".join(f"{k} {columns.schema[k].dataType.simpleString()}" for k in keys)
    return columns.select(*keys, *[F.col(c).cast("array<double>").alias(c) for c in names], "total_precip_mm", "ground_temperature_c").mapInArrow(run, f"{head}, ptype int")
