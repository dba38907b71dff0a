"""Fixed values of the diagnostic, which results depend on: thresholds, formula constants, codes, parameters, models."""

from __future__ import annotations

KELVIN, GRAVITY = 273.15, 9.81
#: Relative humidity over ice (percent) above which a level can hold precipitation.
RH_ICE_PRECIP = 75.0
#: Least depth (m, exclusive) of a generating and of a sublimating layer.
GENERATION_DEPTH, SUBLIMATION_DEPTH = 1000.0, 1500.0
#: Coldest level (deg C) at which all, and at which no, precipitation is ice.
ALL_ICE, NO_ICE = -15.0, -7.0
#: Areas below this energy (J/kg) don't count; the energy of a shallow refreezing surface layer.
LEAST_AREA, SHALLOW_REFREEZING = 2.0, 1.0
GROUND_FREEZING = -3.0
VERTICAL_CUTOFF = 12000.0
#: Dew point.
DEW_TEMPERATURE, DEW_PRESSURE, VAPOUR_RATIO = 5420.0, 2.53e11, 0.622
#: Saturation vapour pressure over ice.
ICE_VAPOUR_PA, ICE_VAPOUR_RATE, TRIPLE_POINT, ICE_VAPOUR_OFFSET = 611.21, 22.587, 273.16, -0.7
#: Wet-bulb approximation.
WB_HALF_STEP, WB_DEW_WEIGHT, WB_DEW_SCALE, WB_TENTHS, WB_PRESSURE_GROWTH, WB_GROWTH_RATE, WB_GROWTH_OFFSET = 0.5, 0.6, 700.0, 0.1, 6400.0, 11.564, 1742.0
#: Ice fraction between NO_ICE and ALL_ICE: coefficients of powers 4 to 0.
ICE_POLYNOMIAL = (-0.065, -3.1544, -56.414, -449.6, -1308.0)

#: Types in the order that breaks ties, with their codes.
TYPES = {
    "freezing_rain": 3,
    "freezing_rain_on_ground": 13,
    "ice_pellets": 8,
    "freezing_drizzle": 12,
    "snow": 5,
    "rain": 1,
}
CODE_NAMES = {0: "no_precip"} | {code: name for name, code in TYPES.items()}
FREEZING_CODES = (3, 8, 12, 13)

PARAMS = {
    "PS": 500000,
    "P": 500001,
    "HSURF": 500007,
    "HHL": 500008,
    "T_G": 500010,
    "T_2M": 500011,
    "T": 500014,
    "QV": 500035,
    "TOT_PREC": 500041,
    "T_S": 500061,
    "QC": 500100,
    "QI": 500101,
    "QR": 500102,
    "QS": 500103,
    "QG": 500106,
    "T_SO": 500166,
}
REQUIRED_PARAMS = ("T", "P", "QV", "HHL", "TOT_PREC", "T_G")
OUTPUT_PARAM, OUTPUT_NAME = 502712, "PTYPE"

FULL_LEVELS, HALF_LEVELS = 80, 81
#: Members and last forecast hour of each model.
MODELS = {"CH1": (11, 33), "CH2": (21, 120)}

QUALITY_COUNTERS = (
    "total_columns",
    "active_columns",
    "invalid_total_precip_columns",
    "invalid_ground_temperature_columns",
    "invalid_profile_columns",
    "invalid_active_ground_temperature_columns",
    "invalid_active_profile_columns",
)
FATAL_COUNTERS = (QUALITY_COUNTERS[2], QUALITY_COUNTERS[5], QUALITY_COUNTERS[6])
