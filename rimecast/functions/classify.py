"""From area energies and ice probability to type probabilities and one code.

Undefined probabilities are NULL: they never win, as NaN never does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as C
from .guards import clip100, log

def ice_probability(coldest: Column) -> Column:
    poly = reduce(lambda acc, c: acc * coldest + c, C.ICE_POLYNOMIAL[1:], F.lit(C.ICE_POLYNOMIAL[0]))
    return F.when(coldest <= C.ALL_ICE, 100.0).when(coldest >= C.NO_ICE, 0.0).otherwise(clip100(poly))


def with_type_probabilities(df: DataFrame, ice: str, generated: str, prefix: str) -> DataFrame:
    """Adds one column for each type, named with the prefix; all are 0 where nothing is generated.

    Needs n_areas, e0 to e2 (areas from the surface up), surface_tw, ground_temperature_c. The areas
    fix which energies melt and refreeze, so each formula occurs once; steps are columns of their
    own, which keeps the generated code small.
    """
    x = lambda name: F.col(f"_{prefix}{name}")
    n, e0, e1, e2 = F.col("n_areas"), F.col("e0"), F.col("e1"), F.col("e2")
    sure = lambda test: F.coalesce(test, F.lit(False))  # noqa: E731  an undefined value is neither cold nor warm
    cold, warm, icy = sure(F.col("surface_tw") < 0), sure(F.col("surface_tw") > 0), sure(F.col("ground_temperature_c") < C.GROUND_FREEZING)
    by_areas = lambda one, two, more: F.when(n == 1, one).when(n == 2, two).when(n > 2, more)
    ramp = lambda r, m: (-2.1 * r + 0.2 * m + 458.0) * F.when(m < 5.0, 0.2 * m).otherwise(1.0)
    share = F.col(ice) / 100.0
    steps = [
        {"m": by_areas(e0, e1, e2), "r": by_areas(F.lit(C.SHALLOW_REFREEZING), F.abs(e0), F.abs(e1)), "w": by_areas(0.29 * e0, 0.28 * e1, 0.28 * (e2 + e0))},
        {"p": 2.3 * x("r") - 42.0 * log(x("m") + 1.0) + 3.0, "l": ramp(x("r"), x("m")), "s": 1540.0 * F.exp(-x("w")), "f": ramp(F.lit(C.SHALLOW_REFREEZING), e0)},
        {k: clip100(x(k)) for k in "plsf"},
        {"p": share * x("p"), "l": (100.0 - F.col(ice)) + share * x("l"), "s": share * x("s"), "f": (100.0 - F.col(ice)) + share * x("f")},
        {k: clip100(x(k)) for k in "plsf"},
    ]
    for step in steps:
        df = df.withColumns({f"_{prefix}{k}": v for k, v in step.items()})
    gone, melted = ~F.col(generated), 100.0 - F.col(ice)
    pick = lambda none=0.0, one=0.0, two=0.0, more=0.0: F.when(gone, 0.0).when(n == 0, none).when(n == 1, one).when(n == 2, two).otherwise(more)
    only = lambda when, v: F.when(when, v).otherwise(0.0)
    df = df.withColumns(
        {
            f"{prefix}freezing_rain": pick(one=only(cold, x("l")), two=F.when(warm, 0.0).otherwise(x("l")), more=only(cold, x("f"))),
            f"{prefix}freezing_rain_on_ground": pick(one=only(icy & ~cold, 100.0 - x("s")), more=only(icy & ~cold, x("l"))),
            f"{prefix}ice_pellets": pick(one=only(cold, x("p")), two=x("p"), more=x("p")),
            f"{prefix}freezing_drizzle": pick(none=F.when(warm, 0.0).otherwise(melted)),
            f"{prefix}snow": pick(F.col(ice), x("s"), x("s"), x("s")),
            f"{prefix}rain": pick(only(warm, melted), F.when(cold, 0.0).otherwise(100.0 - x("s")), 0.0, F.when(cold, 0.0).otherwise(x("l"))),
        }
    )
    return df.drop(*[f"_{prefix}{k}" for k in "mrwplsf"])


def total(p: dict[str, Column]) -> Column:
    """Sum of the six; NULL if any is undefined."""
    return reduce(lambda a, b: a + b, p.values())


def categorical_code(p: dict[str, Column]) -> Column:
    best = F.greatest(*p.values())
    code = F.when(best.isNull() | (best <= 0), 0)
    for name, value in C.TYPES.items():
        code = code.when(p[name] == best, value)
    return code.otherwise(0).cast("int")


def code_name(code: Column) -> Column:
    return F.create_map(*[F.lit(x) for k, v in sorted(C.CODE_NAMES.items()) for x in (k, v)])[code]


def is_freezing(code: Column) -> Column:
    return code.isin(*C.FREEZING_CODES)
