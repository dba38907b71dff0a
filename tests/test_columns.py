"""Scenario columns, golden numbers, edge cases and the agreement of the long and the array path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rimecast.functions import constants as C
from rimecast.functions.classify import categorical_code, with_type_probabilities
from rimecast.functions.thermo import with_thermodynamics
from rimecast.operators import diagnose, energy, kernel, local
from rimecast.operators.quality import DataQualityError

H5, H7, H8 = ([1000.0 * k for k in range(n - 1, -1, -1)] for n in (5, 7, 8))
COLD = [-20.0, -18.0, -16.0, -14.0, -12.0]
NOSE = [-8.0, 2.0, 4.0, 1.0, -1.0]
#: Fixed values, which stand for the agreed behaviour of each rule:
#: name, wet bulb from the top, humidity over ice, heights, precipitation, ground, threshold, code
SCENARIOS = [
    ("snow", COLD, [90.0] * 5, H5, 1.0, -5.0, 0.0, 5),
    ("rain", [-8.0, 1.0, 3.0, 4.0, 5.0], [90.0] * 5, H5, 1.0, 2.0, 0.0, 1),
    ("freezing rain", NOSE, [90.0] * 5, H5, 1.0, -1.0, 0.0, 3),
    ("pellets", [-20.0, -10.0, 2.0, 4.0, 0.0, -4.0, -8.0], [95.0] * 7, H7, 1.0, -8.0, 0.0, 8),
    ("freezing drizzle", [-6.0, -5.0, -4.0, -3.0, -2.0], [50.0, 60.0, 70.0, 80.0, 82.0], H5, 1.0, -4.0, 0.0, 12),
    ("dry", COLD, [90.0] * 5, H5, 0.0, -5.0, 0.0, 0),
    ("below threshold", NOSE, [90.0] * 5, H5, 0.05, -1.0, 0.1, 0),
    ("seeded from above", [-20.0, -18.0, -16.0, -14.0, -12.0, -10.0, -8.0, -6.0], [95.0, 95.0, 95.0, 60.0] + [95.0] * 4, H8, 1.0, -5.0, 0.0, 5),
    ("small area suppressed", [-20.0, 2.0, -0.01, 4.0, 5.0, 6.0, 7.0, 8.0], [95.0] * 8, H8, 1.0, 5.0, 0.0, 1),
    ("one warm area", [-20.0, 2.0, 4.0, 5.0, 6.0, 7.0, 8.0], [95.0] * 7, H7, 1.0, 5.0, 0.0, 1),
    ("freezing on ground", [-8.0, 2.0, 4.0, 5.0, 6.0], [90.0] * 5, H5, 1.0, -4.0, 0.0, 13),
    ("ground not cold enough", [-8.0, 2.0, 4.0, 5.0, 6.0], [90.0] * 5, H5, 1.0, -2.0, 0.0, 1),
    ("relaxed rule", COLD, [50.0, 80.0, 50.0, 50.0, 50.0], H5, 1.0, -5.0, 0.0, 5),
]


def _levels(spark):
    rows = [(i, k, tw, tw, rh, h, pr, tg) for i, (_, tws, rhs, hs, pr, tg, _, _) in enumerate(SCENARIOS) for k, (tw, rh, h) in enumerate(zip(tws, rhs, hs, strict=True))]
    return spark.createDataFrame(rows, "cell_id long, lev int, wet_bulb_c double, temperature_c double, rh_ice_pct double, height_m double, total_precip_mm double, ground_temperature_c double")


def test_scenarios_long(spark):
    state = diagnose.with_probabilities(diagnose.column_state(_levels(spark), ["cell_id"]))
    state = state.withColumns({"p": categorical_code(diagnose._named("p_")), "r": categorical_code(diagnose._named("r_"))})
    got = {r["cell_id"]: r for r in state.collect()}
    for i, (name, *_, pr, _tg, limit, code) in enumerate(SCENARIOS):
        found = 0 if pr <= limit else got[i]["p"] or got[i]["r"]
        assert found == code, name
    assert got[7]["ice"] == 100.0 and got[7]["generated"]
    assert not got[12]["generated"] and got[12]["relaxed_ice"] == 100.0


def test_scenarios_arrays():
    for name, tws, rhs, hs, pr, tg, limit, code in SCENARIOS:
        tw, rh, h = (np.array(x)[:, None] for x in (tws, rhs, hs))
        deep, ice, seen, relaxed = kernel.ice_state(rh, tw, h)
        n, e = kernel.areas(tw, h)
        ground = np.array([tg])
        pure = kernel.codes(n, e, ice, tw[-1], ground)[0] if deep[0] else 0
        other = kernel.codes(n, e, relaxed, tw[-1], ground)[0] if seen[0] else 0
        assert (0 if pr <= limit else pure or other) == code, name


def test_golden_thermodynamics(spark):
    df = spark.createDataFrame([(263.15, 0.0015, 70000.0), (273.15, 0.0035, 85000.0), (278.15, 0.0060, 95000.0)], "temperature_k double, specific_humidity double, pressure_pa double")
    got = with_thermodynamics(df).select("temperature_c", "wet_bulb_c", "rh_ice_pct").collect()
    # fixed values, agreed golden numbers
    want = [(-10.0, -11.66723349, 54.71357185), (0.0, -1.30330555, 75.81552405), (5.0, 5.34851860, 105.80420823)]
    for a, b in zip(got, want, strict=True):
        assert a[0] == pytest.approx(b[0], abs=1e-10)
        assert a[1:] == pytest.approx(b[1:], abs=1e-7)


def test_thermodynamics_edges(spark):
    df = spark.createDataFrame([(270.0, 0.0, 80000.0), (270.0, -0.001, 80000.0), (float("nan"), 0.003, 80000.0), (None, 0.003, 80000.0)], "temperature_k double, specific_humidity double, pressure_pa double")
    dry, negative, nan, null = with_thermodynamics(df).collect()
    assert dry["dew_point_k"] == 0.0 and dry["rh_ice_pct"] == 0.0
    assert negative["dew_point_k"] is None and negative["wet_bulb_c"] is None and negative["rh_ice_pct"] is None
    assert nan["wet_bulb_c"] is None and null["wet_bulb_c"] is None


def test_probability_ties(spark):
    names = list(C.TYPES)
    rows = [tuple([50.0] * 6), tuple(75.0 if n in ("freezing_rain_on_ground", "rain") else 0.0 for n in names), tuple([0.0] * 6), tuple([None] + [0.0] * 4 + [1.0]), tuple([None] * 6)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    assert [r[0] for r in df.select(categorical_code({n: F.col(n) for n in names})).collect()] == [3, 13, 0, 1, 0]


@pytest.mark.parametrize(
    ("e", "ice", "tw", "tg", "want"),
    [
        ([], 65.0, -2.0, -5.0, {"snow": 65.0, "freezing_drizzle": 35.0}),
        ([], 65.0, 2.0, 2.0, {"snow": 65.0, "rain": 35.0}),
        ([75.0], 80.0, 2.0, -4.0, {"rain": 100.0, "freezing_rain_on_ground": 100.0}),
        ([75.0], 80.0, -1.0, -1.0, {"freezing_rain": 100.0}),
        ([-55.0, 90.0], 100.0, 2.0, -6.0, {}),  # warm surface: neither rain nor freezing rain
        ([-40.0, -90.0], 50.0, -2.0, -6.0, None),  # an undefined logarithm never wins
    ],
)
def test_probabilities(spark, e, ice, tw, tg, want):
    full = (e + [None] * 3)[:3]
    df = spark.createDataFrame([(len(e), *full, ice, True, tw, tg)], "n_areas int, e0 double, e1 double, e2 double, ice double, generated boolean, surface_tw double, ground_temperature_c double")
    got = with_type_probabilities(df, "ice", "generated", "").first().asDict()
    if want is None:
        assert got["ice_pellets"] is None
        return
    for n in C.TYPES:
        if n in want or (n != "ice_pellets" and n != "snow"):
            assert got[n] == pytest.approx(want.get(n, 0.0), abs=1e-6), n


def test_signs(spark):
    cases = {0: [0.0, 0.0, -1.0, 0.0, 2.0, 0.0], 1: [0.0, 0.0], 2: [float("nan"), -3.0, float("nan")]}
    want = {0: [-1, -1, -1, -1, 1, 1], 1: [1, 1], 2: [-1, -1, -1]}
    rows = [(i, k, v) for i, vs in cases.items() for k, v in enumerate(vs)]
    df = energy.fill_signs(spark.createDataFrame(rows, "c int, lev int, wet_bulb_c double"), ["c"]).orderBy("c", "lev")
    got = {i: [r["sign"] for r in df.where(F.col("c") == i).collect()] for i in cases}
    assert got == want


def test_random_columns_agree(spark):
    """Long tables and arrays give the same codes on random profiles, some of them broken."""
    rng = np.random.default_rng(3)
    n, k = 400, 24
    h = np.sort(rng.uniform(0, 14000, (n, k)), axis=1)[:, ::-1]
    t = 273.15 + rng.normal(0, 6, (n, k)).cumsum(axis=1) * 0.6
    p = 101325 * np.exp(-h / 8000)
    qv = rng.uniform(0.4, 1.1, (n, k)) * 0.622 * 611.21 * np.exp(22.587 * (t - 273.16) / (t + 0.7)) / p
    qv[rng.random((n, k)) < 0.01] = 0.0
    qv[rng.random((n, k)) < 0.01] *= -1
    rain, ground = rng.choice([0.0, 0.5, 2.0], n), rng.normal(-2, 4, n)
    rows = [(i, h[i].tolist(), t[i].tolist(), p[i].tolist(), qv[i].tolist(), float(rain[i]), float(ground[i])) for i in range(n)]
    arrays = spark.createDataFrame(rows, "cell_id long, height_m array<double>, temperature_k array<double>, pressure_pa array<double>, specific_humidity array<double>, total_precip_mm double, ground_temperature_c double")
    z = arrays.select("cell_id", F.posexplode(F.arrays_zip("height_m", "temperature_k", "pressure_pa", "specific_humidity")).alias("lev", "v"), "total_precip_mm", "ground_temperature_c")
    levels = z.select("cell_id", "lev", "v.*", "total_precip_mm", "ground_temperature_c")
    long = {r["cell_id"]: r["ptype"] for r in diagnose.categorical(levels, ["cell_id"]).collect()}
    fast = {r["cell_id"]: r["ptype"] for r in kernel.categorical_arrays(arrays, ["cell_id"]).collect()}
    assert long == fast
    assert len(set(long.values())) >= 5


def test_local_columns():
    for name, tws, rhs, hs, pr, tg, limit, code in SCENARIOS:
        got = local.diagnose_thermodynamics(tws, tws, rhs, hs, pr, tg, threshold=limit)
        assert got.code == code, name
        if code == 0:
            assert not any(got.probabilities.values())
    last = local.diagnose_thermodynamics(COLD, COLD, [50.0, 80.0, 50.0, 50.0, 50.0], H5, 1.0, -5.0)
    assert sum(last.pure.values()) == 0 and last.ice == 100.0 and last.pure_ice == 0.0
    with pytest.raises(ValueError):
        local.diagnose_thermodynamics(COLD, COLD, COLD, H7, 1.0, 0.0)


def test_local_grid():
    shape = (3, 2)
    t = np.full(shape, 260.0)
    p = np.repeat(np.array([4e4, 7e4, 9e4])[:, None], 2, axis=1)
    half = np.repeat(np.array([9000.0, 6000.0, 3000.0, 0.0])[:, None], 2, axis=1)
    codes, counted = local.diagnose_grid(t, p, np.full(shape, 0.0015), half, [1.0, 0.0], [-5.0, -5.0])
    assert codes.tolist() == [codes[0], 0] and codes[0] > 0 and counted["active_columns"] == 1
    bad = t.copy()
    bad[0, 1] = np.nan
    assert local.diagnose_grid(bad, p, np.full(shape, 0.0015), half, [1.0, 0.0], [-5.0, -5.0])[1]["invalid_profile_columns"] == 1
    with pytest.raises(DataQualityError):
        local.diagnose_grid(bad, p, np.full(shape, 0.0015), half, [1.0, 1.0], [-5.0, -5.0])
    with pytest.raises(ValueError):
        local.diagnose_grid(t, p, t, half[:3], [1.0, 0.0], [0.0, 0.0])


def test_full_grid_agrees_with_columns():
    rng = np.random.default_rng(3)
    n, shape = 12, (4, 5)
    half = np.linspace(9000, 0, n + 1)[:, None, None] + np.zeros((1, *shape))
    t = 250 + np.linspace(0, 30, n)[:, None, None] + rng.normal(0, 4, (n, *shape))
    p = np.linspace(3e4, 1e5, n)[:, None, None] + np.zeros((1, *shape))
    q = rng.uniform(5e-4, 6e-3, (n, *shape))
    rain, ground = rng.choice([0.0, 0.4, 2.0], shape), rng.uniform(-6, 6, shape)
    got = local.diagnose_grid_full(t, p, q, half, rain, ground, threshold=0.1)
    codes, _ = local.diagnose_grid(t, p, q, half, rain, ground, threshold=0.1)
    h = 0.5 * (half[:-1] + half[1:])
    for at in np.ndindex(shape):
        one = local.diagnose_column(t[:, *at], p[:, *at], q[:, *at], h[:, *at], rain[at], ground[at], threshold=0.1)
        assert got.code[at] == one.code == codes[at]
        assert {k: v[at] for k, v in got.probabilities.items()} == pytest.approx(one.probabilities, nan_ok=True)
        assert (got.pure_ice[at], got.ice[at]) == pytest.approx((one.pure_ice, one.ice))
    t[:, 0, 0] = np.nan
    assert local.diagnose_grid_full(t, p, q, half, rain, ground).code.shape == shape  # no gate
    local.warm_up()
