"""DuckDB SQL of the registered queries, from shared building blocks."""

from __future__ import annotations

from ..functions import constants as C

COLUMNS = """
c AS (SELECT o_orderkey AS cell_id, CAST(-12 + o_orderkey % 25 AS DOUBLE) AS ts, CAST(o_orderkey % 4 * 4 AS DOUBLE) AS nose, CAST(o_orderkey % 3 * 3 AS DOUBLE) AS pool,
  0.9e0 + 0.05e0 * (o_orderkey % 7) AS rh_wet, o_orderkey % 6 AS rg, CASE WHEN o_orderkey % 10 < 3 THEN 0.0e0 ELSE (o_totalprice % 100.0e0) / 50.0e0 END AS total_precip_mm FROM orders),
cl AS (SELECT c.*, k.lev, 600.0e0 * (19.5e0 - k.lev) AS height_m FROM c CROSS JOIN (SELECT unnest(range(0, 20)) AS lev) k),
ct AS (SELECT *, ts - 0.0065e0 * height_m + nose * exp(-((height_m - 2000.0e0) / 800.0e0) * ((height_m - 2000.0e0) / 800.0e0)) - pool * exp(-(height_m / 500.0e0) * (height_m / 500.0e0)) + 273.15e0 AS temperature_k,
  101325.0e0 * exp(-height_m / 8000.0e0) AS pressure_pa FROM cl),
levels AS (SELECT cell_id, lev, height_m, temperature_k, pressure_pa, (CASE WHEN rg = 0 AND height_m BETWEEN 2500 AND 5500 THEN 0.4e0 WHEN rg = 1 AND height_m > 4000 THEN 0.3e0 ELSE rh_wet END)
  * 0.622e0 * 611.21e0 * exp(22.587e0 * (temperature_k - 273.16e0) / (temperature_k + 0.7e0)) / pressure_pa AS specific_humidity, total_precip_mm, ts - 2.0e0 * (cell_id % 3) AS ground_temperature_c FROM ct)"""


def synthetic(n_columns: int, n_levels: int) -> str:
    line = lambda a, b: f"{a}e0 + k.lev * (({b}e0 - {a}e0) / {max(1, n_levels - 1)})"
    h = lambda i: f"(10000.0e0 - {i} * (10000.0e0 / {n_levels}))"
    nose = f"CASE WHEN g.cell_id % 2 = 0 AND k.lev >= {n_levels // 2} AND k.lev < {min(n_levels // 2 + 8, n_levels)} THEN 8.0e0 ELSE 0.0e0 END"
    cold = f"CASE WHEN g.cell_id % 4 = 1 AND k.lev >= {n_levels - 8} THEN 4.0e0 ELSE 0.0e0 END"
    return f"""
levels AS (SELECT g.cell_id, k.lev, 0.5e0 * ({h("k.lev")} + {h("(k.lev + 1)")}) AS height_m, {line(253.15, 279.15)} + {nose} - {cold} AS temperature_k, {line(30000.0, 100000.0)} AS pressure_pa,
  {line(0.0004, 0.004)} AS specific_humidity, CASE WHEN g.cell_id < {n_columns // 2} THEN 1.5e0 WHEN g.cell_id < {3 * n_columns // 4} THEN 0.2e0 ELSE 0.0e0 END AS total_precip_mm,
  CASE WHEN g.cell_id % 3 = 0 THEN -4.0e0 ELSE 2.0e0 END AS ground_temperature_c
  FROM (SELECT unnest(range(0, {n_columns})) AS cell_id) g CROSS JOIN (SELECT unnest(range(0, {n_levels})) AS lev) k)"""


THERMO = f"""
t1 AS (SELECT *, temperature_k - {C.KELVIN} AS temperature_c, CASE WHEN specific_humidity * pressure_pa > 0 THEN {C.DEW_TEMPERATURE}e0 / ln({C.DEW_PRESSURE * C.VAPOUR_RATIO!r} / (specific_humidity * pressure_pa))
  WHEN specific_humidity * pressure_pa = 0 THEN 0.0e0 END AS dew_point_k FROM levels),
t2 AS (SELECT *, exp(22.587e0 * (dew_point_k - 273.16e0) / (dew_point_k + 0.7e0)) / exp(22.587e0 * (temperature_k - 273.16e0) / (temperature_k + 0.7e0)) * 100.0e0 AS rh_ice_pct,
  temperature_c * 10.0e0 AS tl, (dew_point_k - 273.15e0) * 10.0e0 AS tp FROM t1),
t3 AS (SELECT *, tp + 0.5e0 * (tl - tp) * (0.6e0 - tp / 700.0e0) AS zt FROM t2),
thermo AS (SELECT cell_id, lev, height_m, temperature_c, dew_point_k, rh_ice_pct, 0.1e0 * (tp + (tl - tp) / (1.0e0 + 64000.0e0 * exp(11.564e0 * zt / (1742.0e0 + zt)) / pressure_pa)) AS wet_bulb_c,
  total_precip_mm, ground_temperature_c FROM t3)"""

LAYERS = """
m1 AS (SELECT *, rh_ice_pct > 75 AS moist FROM thermo),
m2 AS (SELECT *, CASE WHEN moist <> lag(moist) OVER (PARTITION BY cell_id ORDER BY lev) THEN 1 ELSE 0 END AS nl FROM m1),
m3 AS (SELECT *, sum(nl) OVER (PARTITION BY cell_id ORDER BY lev) AS layer FROM m2),
layers AS (SELECT cell_id, layer, any_value(moist) AS moist, min(lev) AS first_lev, count(*) AS n_levels, max(height_m) - min(height_m) AS depth_m, min(temperature_c) AS coldest_c FROM m3 GROUP BY cell_id, layer)"""

_POLY = "greatest(0.0e0, least(100.0e0, (((-0.065e0 * {0} - 3.1544e0) * {0} - 56.414e0) * {0} - 449.6e0) * {0} - 1308.0e0))"


def _ice(x: str) -> str:
    return f"CASE WHEN {x} <= -15 THEN 100.0e0 WHEN {x} >= -7 THEN 0.0e0 ELSE {_POLY.format(x)} END"


ICE = f"""
i1 AS (SELECT *, max(CASE WHEN NOT moist AND depth_m > 1500 THEN first_lev END) OVER (PARTITION BY cell_id) AS dry_from FROM layers),
i2 AS (SELECT *, moist AND first_lev > coalesce(dry_from, -1) AS clear FROM i1),
i3 AS (SELECT cell_id, bool_or(clear AND depth_m > 1000) AS generated, min(coldest_c) FILTER (WHERE clear AND depth_m > 1000) AS s, bool_or(moist) AS relaxed_generated,
  coalesce(min(coldest_c) FILTER (WHERE clear), arg_max(coldest_c, first_lev) FILTER (WHERE moist)) AS r FROM i2 GROUP BY cell_id),
ice AS (SELECT cell_id, generated, CASE WHEN generated THEN {_ice("s")} ELSE 0.0e0 END AS ice, relaxed_generated, CASE WHEN relaxed_generated THEN {_ice("r")} ELSE 0.0e0 END AS relaxed_ice FROM i3)"""


def areas(source: str, key: str) -> str:
    """CTEs sgn, seg, area, up over a source with key, lev, height_m, wet_bulb_c."""
    w = f"PARTITION BY {key} ORDER BY lev"
    return f"""
s0 AS (SELECT *, CASE WHEN wet_bulb_c > 0 THEN 1 WHEN wet_bulb_c < 0 THEN -1 END AS own FROM {source}),
sgn AS (SELECT *, coalesce(last_value(own IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(own IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1) AS sign FROM s0),
s1 AS (SELECT *, CASE WHEN sign <> lag(sign) OVER ({w}) THEN 1 ELSE 0 END AS ns, CASE WHEN lead(sign) OVER ({w}) = sign
  THEN 0.5e0 * (wet_bulb_c + lead(wet_bulb_c) OVER ({w})) / 273.15e0 * (height_m - lead(height_m) OVER ({w})) * 9.81e0 END AS term FROM sgn),
s2 AS (SELECT *, sum(ns) OVER ({w}) AS segment FROM s1),
seg AS (SELECT {key}, segment, any_value(sign) AS sign, min(lev) AS first_lev, count(*) AS n_levels, coalesce(sum(term), 0.0e0) AS energy FROM s2 GROUP BY {key}, segment),
a1 AS (SELECT *, sign(energy) AS es FROM seg WHERE segment > 0 AND abs(energy) >= 2),
a2 AS (SELECT *, CASE WHEN es <> lag(es) OVER (PARTITION BY {key} ORDER BY segment) THEN 1 ELSE 0 END AS na FROM a1),
a3 AS (SELECT *, sum(na) OVER (PARTITION BY {key} ORDER BY segment) AS area FROM a2),
area AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY area DESC) AS rank FROM (SELECT {key}, area, sum(energy) AS energy FROM a3 GROUP BY {key}, area)),
up AS (SELECT {key}, count(*) AS n_all, max(energy) FILTER (WHERE rank = 1) AS e0, max(energy) FILTER (WHERE rank = 2) AS e1, max(energy) FILTER (WHERE rank = 3) AS e2 FROM area GROUP BY {key})"""


def _clip(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN 0.0e0 WHEN {x} > 100 THEN 100.0e0 ELSE {x} END)"


def _types(ice: str, flag: str) -> dict[str, str]:
    log = lambda m: f"(CASE WHEN {m} + 1 > 0 THEN ln({m} + 1.0e0) WHEN {m} + 1 = 0 THEN -1e308 END)"
    pellets = lambda r, m: _clip(f"({ice} / 100.0e0 * {_clip(f'(2.3e0 * {r} - 42.0e0 * {log(m)} + 3.0e0)')})")
    ramp = lambda r, m: f"((-2.1e0 * {r} + 0.2e0 * {m} + 458.0e0) * (CASE WHEN {m} < 5 THEN 0.2e0 * {m} ELSE 1.0e0 END))"
    fluid = lambda r, m: _clip(f"((100.0e0 - {ice}) + {ice} / 100.0e0 * {_clip(ramp(r, m))})")
    snow = lambda k, m: _clip(f"({ice} / 100.0e0 * {_clip(f'(1540.0e0 * exp(-{k}e0 * ({m})))')})")
    cold, warm, icy = "tw < 0", "tw > 0", "tg < -3"
    s1, l3 = snow(0.29, "e0"), fluid("abs(e1)", "e2")
    when = lambda c, a, b="0.0e0": f"CASE WHEN {c} THEN {a} ELSE {b} END"
    by = {
        "freezing_rain": ("0.0e0", when(cold, fluid("1.0e0", "e0")), when(warm, "0.0e0", fluid("abs(e0)", "e1")), when(cold, fluid("1.0e0", "e0"))),
        "freezing_rain_on_ground": ("0.0e0", when(f"{icy} AND NOT {cold}", f"100.0e0 - {s1}"), "0.0e0", when(f"{icy} AND NOT {cold}", l3)),
        "ice_pellets": ("0.0e0", when(cold, pellets("1.0e0", "e0")), pellets("abs(e0)", "e1"), pellets("abs(e1)", "e2")),
        "freezing_drizzle": (when(warm, "0.0e0", f"100.0e0 - {ice}"), "0.0e0", "0.0e0", "0.0e0"),
        "snow": (ice, s1, snow(0.28, "e1"), snow(0.28, "e2 + e0")),
        "rain": (when(warm, f"100.0e0 - {ice}"), when(cold, "0.0e0", f"100.0e0 - {s1}"), "0.0e0", when(cold, "0.0e0", l3)),
    }
    return {k: f"CASE WHEN NOT {flag} THEN 0.0e0 WHEN n_areas = 0 THEN {a} WHEN n_areas = 1 THEN {b} WHEN n_areas = 2 THEN {c} ELSE {d} END" for k, (a, b, c, d) in by.items()}


def _code(prefix: str) -> str:
    names = [f"{prefix}{k}" for k in C.TYPES]
    best = f"greatest({', '.join(names)})"
    return f"CASE WHEN {best} IS NULL OR {best} <= 0 THEN 0 " + " ".join(f"WHEN {prefix}{k} = {best} THEN {v}" for k, v in C.TYPES.items()) + " ELSE 0 END"


_P = ", ".join(f"{v} AS p_{k}" for k, v in _types("ice", "generated").items()) + ", " + ", ".join(f"{v} AS r_{k}" for k, v in _types("relaxed_ice", "relaxed_generated").items())
PROBABILITIES = f"""
surface AS (SELECT cell_id, arg_max(wet_bulb_c, lev) AS tw, any_value(ground_temperature_c) AS tg, any_value(total_precip_mm) AS total_precip_mm FROM thermo GROUP BY cell_id),
state AS (SELECT *, least(coalesce(n_all, 0), CASE WHEN tw < 0 THEN 2 ELSE 3 END) AS n_areas FROM ice JOIN surface USING (cell_id) LEFT JOIN up USING (cell_id)),
prob AS (SELECT *, {_P} FROM state)"""

STATE = f"{THERMO},{LAYERS},{ICE},{areas('thermo', 'cell_id')},{PROBABILITIES}"
PTYPE = f"WITH {{levels}},{STATE}, pure AS (SELECT *, {_code('p_')} AS pc, {_code('r_')} AS rc FROM prob), codes AS (SELECT cell_id, CAST(CASE WHEN NOT total_precip_mm > 0 THEN 0 WHEN pc <> 0 THEN pc ELSE rc END AS INTEGER) AS ptype FROM pure)"


def ptype(levels: str = COLUMNS) -> str:
    return PTYPE.format(levels=levels)


_SUM = " + ".join(f"p_{k}" for k in C.TYPES)
_MIX = ", ".join(f"CASE WHEN total_precip_mm <= 0 THEN 0.0e0 WHEN {_SUM} = 0 THEN r_{k} ELSE p_{k} END AS {k}" for k in C.TYPES)
FULL = f"WITH {COLUMNS},{STATE}, mixed AS (SELECT cell_id, ice AS pure_ice, CASE WHEN total_precip_mm > 0 AND {_SUM} = 0 THEN relaxed_ice ELSE ice END AS ice, {_MIX} FROM prob)"
FULL += f" SELECT cell_id, round(pure_ice, 6) AS pure_ice, round(ice, 6) AS ice, {', '.join(f'round({k}, 6) AS {k}' for k in C.TYPES)}, CAST({_code('')} AS INTEGER) AS ptype FROM mixed"

ACCUMULATED = """
h AS (SELECT user_id AS cell_id, (day(ts) - 1) * 24 + hour(ts) AS step, sum(value) AS inc FROM events GROUP BY 1, 2),
g AS (SELECT a.cell_id, b.step FROM (SELECT DISTINCT cell_id FROM h) a CROSS JOIN (SELECT DISTINCT step FROM h) b),
acc AS (SELECT g.cell_id, g.step, sum(coalesce(h.inc, 0.0e0)) OVER (PARTITION BY g.cell_id ORDER BY g.step) AS tot_prec FROM g LEFT JOIN h ON g.cell_id = h.cell_id AND g.step = h.step)"""

#: Levels of the derived run above its vertical cut, each member, step and cell under one number.
RUN_COLUMNS = COLUMNS.replace("levels AS (", "base AS (") + """,
levels AS (SELECT CAST(m AS BIGINT) * 1000000000 + s * 500000000 + cell_id AS cell_id, lev, height_m, temperature_k + 2.0e0 * m - 1.5e0 * s AS temperature_k, pressure_pa, specific_humidity, total_precip_mm, ground_temperature_c + 0.25e0 - s AS ground_temperature_c
  FROM base, (VALUES (0), (1), (2)) ms(m), (VALUES (0), (1)) ss(s) WHERE height_m <= 9000)"""

EMBEDDED = "levels AS (SELECT vec_id, i - 1 AS lev, 12000.0e0 - 187.5e0 * (i - 1) AS height_m, 20.0e0 * CAST(embedding[i] AS DOUBLE) AS wet_bulb_c FROM embeddings, range(1, 65) r(i))"
