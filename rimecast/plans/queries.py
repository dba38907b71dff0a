"""The registered queries over tables derived from the star schema, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import classify, guards, thermo, tokens
from ..functions import constants as C
from ..functions.sql_tables import register_tables
from ..operators import align, blocks, diagnose, energy, kernel, layers, quality, temporal, validate, vertical
from ..scratch import shared_dir
from ..sources import fixtures as fx
from ..sources.field_source import MessageStore, write_field_parts
from ..sources.field_store import FieldStore, write_fields
from ..sources.sinks import read_categorical, read_codes
from ..sources.synthetic import synthetic_arrays, synthetic_levels
from ..streaming.blocks import replay_blocks
from ..streaming.deaccumulate import replay
from . import bitmaps, catalog, monitoring
from . import oracles as O
from . import run as runs
from .config import RunConfig

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEY = ["cell_id"]


def query(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def r6(name: str, places: int = 6) -> Column:
    return F.round(name, places).alias(name)


def _rounded(names: str, places: int = 6) -> str:
    return ", ".join(f"round({n}, {places}) AS {n}" for n in names.split())


# scans and projections


@query(f"WITH {O.COLUMNS} SELECT cell_id, CAST(lev AS INTEGER) AS lev, {_rounded('height_m temperature_k pressure_pa', 4)}, round(specific_humidity, 9) AS specific_humidity, {_rounded('total_precip_mm ground_temperature_c', 4)} FROM levels")
def scan_levels(spark, sf_dir):
    t = fx.profile_levels(spark, sf_dir, together=False)
    four = [r6(c, 4) for c in ("height_m", "temperature_k", "pressure_pa", "total_precip_mm", "ground_temperature_c")]
    return t.select("cell_id", "lev", *four, r6("specific_humidity", 9))


@query(
    "WITH h AS (SELECT o_orderkey AS cell_id, k.lev, 800.0e0 * (20.0e0 - k.lev) - 100.0e0 * (o_orderkey % 3) AS hhl_m FROM orders CROSS JOIN (SELECT unnest(range(0, 21)) AS lev) k),"
    " n AS (SELECT *, lead(hhl_m) OVER (PARTITION BY cell_id ORDER BY lev) AS below FROM h)"
    " SELECT cell_id, CAST(lev AS INTEGER) AS lev, 0.5e0 * (hhl_m + below) AS height_m, below + (hhl_m - below) / 2.0e0 AS height_offset_m FROM n WHERE below IS NOT NULL"
)
def full_level_heights(spark, sf_dir):
    return thermo.full_level_heights(fx.half_levels(spark, sf_dir), KEY)


@query(f"WITH {O.COLUMNS},{O.THERMO} SELECT cell_id, CAST(lev AS INTEGER) AS lev, {_rounded('temperature_c dew_point_k rh_ice_pct wet_bulb_c')} FROM thermo")
def thermodynamics(spark, sf_dir):
    t = thermo.with_thermodynamics(fx.profile_levels(spark, sf_dir, together=False))
    return t.select("cell_id", "lev", *[r6(c) for c in ("temperature_c", "dew_point_k", "rh_ice_pct", "wet_bulb_c")])


# layers


def _moist_layers(spark, sf_dir):
    return layers.layers(layers.mark_layers(thermo.with_thermodynamics(fx.profile_levels(spark, sf_dir)), KEY), KEY)


@query(f"WITH {O.COLUMNS},{O.THERMO},{O.LAYERS} SELECT cell_id, CAST(layer AS BIGINT) AS layer, moist, CAST(first_lev AS INTEGER) AS first_lev, CAST(n_levels AS BIGINT) AS n_levels, {_rounded('depth_m coldest_c')} FROM layers")
def rh_layers(spark, sf_dir):
    return _moist_layers(spark, sf_dir).select("cell_id", "layer", "moist", "first_lev", "n_levels", r6("depth_m"), r6("coldest_c"))


_ICE = f"WITH {O.COLUMNS},{O.THERMO},{O.LAYERS},{O.ICE} SELECT cell_id, "


@query(_ICE + "generated, round(ice, 6) AS ice FROM ice")
def prob_ice_pure(spark, sf_dir):
    return layers.ice_probabilities(_moist_layers(spark, sf_dir), KEY).select("cell_id", "generated", r6("ice"))


@query(_ICE + "relaxed_generated, round(relaxed_ice, 6) AS relaxed_ice FROM ice")
def prob_ice_relaxed(spark, sf_dir):
    return layers.ice_probabilities(_moist_layers(spark, sf_dir), KEY).select("cell_id", "relaxed_generated", r6("relaxed_ice"))


# areas

_EMB = f"WITH {O.EMBEDDED},{O.areas('levels', 'vec_id')} SELECT vec_id, "
_THR = f"WITH {O.COLUMNS},{O.THERMO},{O.areas('thermo', 'cell_id')}"
VEC = ["vec_id"]


def _segments(levels: DataFrame, keys: list[str]) -> DataFrame:
    return energy.segments(energy.mark_segments(energy.fill_signs(levels, keys), keys), keys)


@query(_EMB + "CAST(lev AS INTEGER) AS lev, CAST(sign AS INTEGER) AS sign FROM sgn")
def wetbulb_sign_fill(spark, sf_dir):
    return energy.fill_signs(fx.wet_bulb_levels(spark, sf_dir), VEC).select("vec_id", "lev", "sign")


@query(
    "WITH z AS (SELECT vec_id, i - 1 AS lev, 0.0e0 AS height_m, CASE WHEN abs(embedding[i]) < 0.15 THEN 0.0e0 ELSE 20.0e0 * CAST(embedding[i] AS DOUBLE) END AS wet_bulb_c FROM embeddings, range(1, 65) r(i)),"
    + O.areas("z", "vec_id") + " SELECT vec_id, CAST(lev AS INTEGER) AS lev, CAST(sign AS INTEGER) AS sign FROM sgn"
)
def wetbulb_zero_fill(spark, sf_dir):
    """Sign fill with many exact zeros."""
    w = fx.wet_bulb_levels(spark, sf_dir).withColumn("wet_bulb_c", F.when(F.abs("wet_bulb_c") < 20.0 * 0.15, 0.0).otherwise(F.col("wet_bulb_c")))
    return energy.fill_signs(w, VEC).select("vec_id", "lev", "sign")


@query(_EMB + "CAST(segment AS BIGINT) AS segment, CAST(sign AS INTEGER) AS sign, CAST(first_lev AS INTEGER) AS first_lev, CAST(n_levels AS BIGINT) AS n_levels, round(energy, 6) AS energy FROM seg")
def segment_energy(spark, sf_dir):
    return _segments(fx.wet_bulb_levels(spark, sf_dir), VEC).select("vec_id", "segment", "sign", "first_lev", "n_levels", r6("energy"))


@query(_EMB + "CAST(rank AS INTEGER) AS rank, round(energy, 6) AS energy FROM area")
def merged_areas(spark, sf_dir):
    return energy.merged_areas(_segments(fx.wet_bulb_levels(spark, sf_dir), VEC), VEC).select("vec_id", "rank", r6("energy"))


@query(_THR + f" SELECT cell_id, CAST(n_all AS BIGINT) AS n_all, {_rounded('e0 e1 e2')} FROM up")
def surface_up_energies(spark, sf_dir):
    t = thermo.with_thermodynamics(fx.profile_levels(spark, sf_dir))
    return energy.surface_up(energy.merged_areas(_segments(t, KEY), KEY), KEY).select("cell_id", "n_all", r6("e0"), r6("e1"), r6("e2"))


# classification


@query(O.FULL)
def type_probabilities(spark, sf_dir):
    t = diagnose.diagnose_levels(fx.profile_levels(spark, sf_dir), KEY)
    return t.select("cell_id", r6("pure_ice"), r6("ice"), *[r6(k) for k in C.TYPES], "ptype")


@query(O.ptype() + " SELECT cell_id, ptype FROM codes")
def ptype_grid(spark, sf_dir):
    """The flagship: one code per column, over long tables."""
    return diagnose.categorical(fx.profile_levels(spark, sf_dir), KEY)


@query(O.ptype() + " SELECT cell_id, ptype FROM codes")
def diagnose_sql(spark, sf_dir):
    """The same asked in SQL, as a table function over a partitioned table of blocks of columns."""
    register_tables(spark)
    top = F.col("lev") == 0
    levels = fx.profile_blocks(fx.column_blocks(spark, sf_dir)).select(
        "block", "lev", "height_m", "pressure_pa", "temperature_k", "specific_humidity", F.when(top, F.col("cells.cell_id")).alias("cell_id"), F.when(top, F.col("cells.total_precip_mm")).alias("total_precip_mm"),
        F.when(top, F.transform("cells", lambda c: c["ts"] - 2.0 * (c["cell_id"] % 3))).alias("ground_temperature_c"),
    )
    found = spark.sql("SELECT explode(arrays_zip(cell_id, ptype)) AS c FROM diagnose(TABLE({levels}) PARTITION BY block ORDER BY lev)", levels=levels)
    return found.select("c.cell_id", "c.ptype")


@query(O.ptype() + " SELECT cell_id, ptype FROM codes")
def ptype_array_fastpath(spark, sf_dir):
    """The same from array columns: one pass, no exchange."""
    return kernel.categorical_arrays(fx.profile_arrays(spark, sf_dir), KEY)


_NAMES = "CASE ptype " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in C.CODE_NAMES.items()) + " END"


@query(O.ptype() + f" SELECT ptype, {_NAMES} AS name, ptype IN (3, 8, 12, 13) AS freezing, count(*) AS n FROM codes GROUP BY ptype")
def ptype_counts(spark, sf_dir):
    c = kernel.categorical_arrays(fx.profile_arrays(spark, sf_dir), KEY)
    return c.groupBy("ptype").agg(F.count("*").alias("n")).select("ptype", classify.code_name(F.col("ptype")).alias("name"), classify.is_freezing(F.col("ptype")).alias("freezing"), "n")


@query("SELECT * FROM (VALUES " + ", ".join(f"({k}, '{v}', {str(k in C.FREEZING_CODES).lower()})" for k, v in C.CODE_NAMES.items()) + ") t(code, name, freezing)")
def code_name_lookup(spark, sf_dir):
    codes = spark.createDataFrame([(k,) for k in C.CODE_NAMES], "code int")
    return codes.select("code", classify.code_name(F.col("code")).alias("name"), classify.is_freezing(F.col("code")).alias("freezing"))


# time


@query(f"WITH {O.ACCUMULATED} SELECT cell_id, CAST(step AS INTEGER) AS step, round(CASE WHEN row_number() OVER w = 1 THEN tot_prec ELSE tot_prec - lag(tot_prec) OVER w END, 6) + 0.0e0 AS total_precip_mm FROM acc WINDOW w AS (PARTITION BY cell_id ORDER BY step)")
def deaccumulate(spark, sf_dir):
    return temporal.deaccumulate(fx.accumulated(spark, sf_dir), KEY).select("cell_id", "step", r6("total_precip_mm"))


def _hours(spark, sf_dir) -> DataFrame:
    """Accumulated amounts with steps numbered without gaps."""
    a = fx.accumulated(spark, sf_dir)
    return a.withColumn("step", (F.row_number().over(Window.partitionBy("cell_id").orderBy("step")) - 1).cast("int"))


@query(
    f"WITH {O.ACCUMULATED}, n AS (SELECT cell_id, row_number() OVER (PARTITION BY cell_id ORDER BY step) - 1 AS step, tot_prec FROM acc)"
    " SELECT cell_id, CAST(step AS INTEGER) AS step, round(CASE WHEN step = 0 THEN tot_prec ELSE tot_prec - lag(tot_prec) OVER (PARTITION BY cell_id ORDER BY step) END, 6) + 0.0e0 AS total_precip_mm FROM n"
)
def deaccumulate_stream(spark, sf_dir):
    """The whole table through the streaming operator, out of order."""
    return replay(_hours(spark, sf_dir), f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}").select("cell_id", "step", r6("total_precip_mm"))


@query(ORACLES["deaccumulate_stream"])
def deaccumulate_blocks_stream(spark, sf_dir):
    """The same as blocks of 64 cells with state in RocksDB, the stream ended and begun anew half way."""
    hours = _hours(spark, sf_dir).withColumn("block", F.floor(F.col("cell_id") / 64).cast("int"))
    blocks = hours.groupBy("block", "step").agg(F.sort_array(F.collect_list(F.struct("cell_id", "tot_prec"))).alias("c"))  # 64 cells
    users = fx.table(spark, sf_dir, "events").select(F.col("user_id").alias("cell_id")).distinct()
    cells = users.groupBy(F.floor(F.col("cell_id") / 64).cast("int").alias("block")).agg(F.sort_array(F.collect_list("cell_id")).alias("cells"))
    out = replay_blocks(blocks.select("block", "step", F.col("c.tot_prec").alias("vals")), ["block"], f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}")
    # cells join as blocks, and only then become rows
    long = out.join(cells, "block").select("step", F.explode(F.arrays_zip("cells", "amounts")).alias("c"))
    return long.select(F.col("c.cells").alias("cell_id"), "step", F.round("c.amounts", 6).alias("total_precip_mm"))


@query(
    f"WITH {O.ACCUMULATED}, s AS (SELECT DISTINCT step FROM acc) SELECT CAST(floor(step / 5) AS BIGINT) AS chunk, CAST(min(step) AS INTEGER) AS first, CAST(max(step) AS INTEGER) AS last, count(*) AS n,"
    " CASE WHEN count(*) = 1 THEN CAST(min(step) AS VARCHAR) WHEN max(step) - min(step) + 1 = count(*) THEN min(step) || '/to/' || max(step) || '/by/1' END AS steps FROM s GROUP BY 1"
)
def step_chunks(spark, sf_dir):
    return temporal.step_chunks(fx.accumulated(spark, sf_dir), 5)


# tokens


@query(
    f"WITH {O.ACCUMULATED} SELECT DISTINCT CAST(step AS INTEGER) AS step, lpad(CAST(step // 24 AS VARCHAR), 2, '0') || lpad(CAST(step % 24 AS VARCHAR), 2, '0') || '0000' AS token,"
    " 'out/CH2/20240101/0000/' || lpad(CAST(step % 21 AS VARCHAR), 3, '0') || '/lfff' || lpad(CAST(step // 24 AS VARCHAR), 2, '0') || lpad(CAST(step % 24 AS VARCHAR), 2, '0') || '0000.ptype.grib2' AS path FROM acc"
)
def step_tokens(spark, sf_dir):
    s = fx.accumulated(spark, sf_dir).select("step").distinct()
    member = F.lpad((F.col("step") % 21).cast("string"), 3, "0")
    path = tokens.output_path("out", F.lit("CH2"), F.lit("20240101"), F.lit("0000"), member, F.col("step"))
    return s.select("step", tokens.step_token(F.col("step")).alias("token"), path.alias("path"))


@query(
    "WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id % 50 * 60 AS VARCHAR) || 'm' WHEN 1 THEN CAST(event_id % 50 AS VARCHAR) || 'h' WHEN 2 THEN CAST(event_id % 50 AS VARCHAR) || '.7' ELSE CAST(event_id % 120 AS VARCHAR) || 'm' END AS text FROM events)"
    " SELECT event_id, text, CASE event_id % 4 WHEN 3 THEN CASE WHEN event_id % 120 % 60 = 0 THEN CAST(event_id % 120 // 60 AS INTEGER) END ELSE CAST(event_id % 50 AS INTEGER) END AS step FROM t"
)
def step_parse(spark, sf_dir):
    e = F.col("event_id")
    text = F.when(e % 4 == 0, F.concat((e % 50 * 60).cast("string"), F.lit("m"))).when(e % 4 == 1, F.concat((e % 50).cast("string"), F.lit("h")))
    text = text.when(e % 4 == 2, F.concat((e % 50).cast("string"), F.lit(".7"))).otherwise(F.concat((e % 120).cast("string"), F.lit("m")))
    return fx.table(spark, sf_dir, "events").select("event_id", text.alias("text")).select("event_id", "text", tokens.parse_step(F.col("text")).alias("step"))


@query(
    "WITH m AS (SELECT c_custkey, lpad(CAST(c_custkey % 23 AS VARCHAR), CASE WHEN c_custkey % 11 = 0 THEN 2 ELSE 3 END, '0') AS member FROM customer),"
    " k AS (SELECT *, CASE WHEN member = '000' THEN 'cf' WHEN regexp_full_match(member, '\\d{3}') THEN 'pf' END AS kind FROM m)"
    " SELECT c_custkey, member, kind, CASE WHEN kind = 'pf' THEN CAST(member AS INTEGER) END AS number, 'model=CH2' || coalesce(',type=' || kind, '') || CASE WHEN kind = 'pf' THEN ',number=' || CAST(CAST(member AS INTEGER) AS VARCHAR) ELSE '' END AS filter FROM k"
)
def member_keys(spark, sf_dir):
    k = F.col("c_custkey")
    m = fx.table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 11 == 0, F.lpad((k % 23).cast("string"), 2, "0")).otherwise(F.lpad((k % 23).cast("string"), 3, "0")).alias("member"))
    kind, number = tokens.member_kind(F.col("member")), tokens.member_number(F.col("member"))
    return m.select("c_custkey", "member", kind.alias("kind"), number.alias("number"), tokens.filter_expression({"model": F.lit("CH2"), "type": kind, "number": number}).alias("filter"))


_PARAMS = ", ".join(f"({i}, '{n}')" for n, i in C.PARAMS.items())


@query(f"SELECT p_partkey, p.id AS param_id, p.name AS param FROM part JOIN (SELECT row_number() OVER (ORDER BY id) - 1 AS k, id, name FROM (VALUES {_PARAMS}) v(id, name)) p ON p_partkey % {len(C.PARAMS)} = p.k")
def param_names(spark, sf_dir):
    ids = F.array(*[F.lit(i) for i in sorted(C.PARAMS.values())])
    f = fx.table(spark, sf_dir, "part").select("p_partkey", F.get(ids, (F.col("p_partkey") % len(C.PARAMS)).cast("int")).alias("param_id"))
    return align.param_names(f)


# alignment


@query(f"WITH {O.COLUMNS} SELECT cell_id, CAST(lev AS INTEGER) AS lev, {_rounded('temperature_k pressure_pa', 4)}, round(specific_humidity, 9) AS specific_humidity, {_rounded('total_precip_mm ground_temperature_c', 4)} FROM levels")
def align_params(spark, sf_dir):
    """Fields one below the other, put side by side again with the surface attached."""
    t = fx.profile_levels(spark, sf_dir)
    pairs = F.array(*[F.struct(F.lit(C.PARAMS[p]).alias("param_id"), F.col(c).alias("value")) for p, c in (("T", "temperature_k"), ("P", "pressure_pa"), ("QV", "specific_humidity"))])
    fields = t.select("cell_id", "lev", F.explode(pairs).alias("f")).select("cell_id", "lev", "f.*")
    surface = t.where("lev = 19").select("cell_id", "total_precip_mm", (F.col("ground_temperature_c") + C.KELVIN).alias("ground_temperature_k"))
    out = align.attach_surface(align.align_levels(fields, KEY), surface, KEY)
    return out.select("cell_id", "lev", r6("temperature_k", 4), r6("pressure_pa", 4), r6("specific_humidity", 9), r6("total_precip_mm", 4), r6("ground_temperature_c", 4))


@query("SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def last_field_wins(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return align.last_of_each(o, ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey", r6("o_totalprice", 2))


# quality

_BROKEN = (
    "bad AS (SELECT cell_id, lev, height_m, CASE WHEN cell_id % 97 = 0 AND lev = 3 THEN CAST('NaN' AS DOUBLE) ELSE temperature_k END AS temperature_k, CASE WHEN cell_id % 89 = 0 AND lev = 5 THEN CAST('Infinity' AS DOUBLE) ELSE pressure_pa END AS pressure_pa,"
    " specific_humidity, CASE WHEN cell_id % 83 = 0 THEN CAST('NaN' AS DOUBLE) ELSE total_precip_mm END AS total_precip_mm, CASE WHEN cell_id % 79 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE ground_temperature_c END AS ground_temperature_c FROM levels),"
    " f AS (SELECT cell_id, bool_and(isfinite(total_precip_mm) AND total_precip_mm > 0) AS active, bool_and(isfinite(total_precip_mm)) AS r, bool_and(isfinite(ground_temperature_c)) AS g,"
    " bool_and(isfinite(temperature_k) AND isfinite(pressure_pa) AND isfinite(specific_humidity) AND isfinite(height_m)) AS p FROM bad GROUP BY cell_id)"
)
_COUNTERS = (
    "count(*) AS total_columns, count(*) FILTER (WHERE active) AS active_columns, count(*) FILTER (WHERE NOT r) AS invalid_total_precip_columns, count(*) FILTER (WHERE NOT g) AS invalid_ground_temperature_columns,"
    " count(*) FILTER (WHERE NOT p) AS invalid_profile_columns, count(*) FILTER (WHERE active AND NOT g) AS invalid_active_ground_temperature_columns, count(*) FILTER (WHERE active AND NOT p) AS invalid_active_profile_columns"
)


def _broken(spark, sf_dir) -> DataFrame:
    c = F.col("cell_id")
    return fx.profile_levels(spark, sf_dir).withColumns(
        {
            "temperature_k": F.when((c % 97 == 0) & (F.col("lev") == 3), float("nan")).otherwise(F.col("temperature_k")),
            "pressure_pa": F.when((c % 89 == 0) & (F.col("lev") == 5), guards.INF).otherwise(F.col("pressure_pa")),
            "total_precip_mm": F.when(c % 83 == 0, float("nan")).otherwise(F.col("total_precip_mm")),
            "ground_temperature_c": F.when(c % 79 == 0, -guards.INF).otherwise(F.col("ground_temperature_c")),
        }
    )


@query(f"WITH {O.COLUMNS}, {_BROKEN} SELECT {_COUNTERS} FROM f")
def quality_counters(spark, sf_dir):
    return quality.counters(quality.column_flags(_broken(spark, sf_dir), KEY))


@query(f"WITH {O.COLUMNS}, {_BROKEN} SELECT cell_id % 4 AS step, {_COUNTERS} FROM f GROUP BY 1")
def quality_by_step(spark, sf_dir):
    flags = quality.column_flags(_broken(spark, sf_dir), KEY).withColumns({"step": F.col("cell_id") % 4, "part": F.col("cell_id") % 12})
    return quality.merge(quality.counters(flags, ["step", "part"]), ["step"])


@query(f"WITH {O.COLUMNS}, {_BROKEN}, b AS (SELECT cell_id, row_number() OVER (ORDER BY cell_id) AS k FROM f WHERE active AND NOT p) SELECT coalesce(string_agg(CAST(cell_id AS VARCHAR), ',' ORDER BY cell_id) FILTER (WHERE k <= 5), '') || CASE WHEN count(*) > 5 THEN ',...' ELSE '' END AS preview FROM b")
def bad_column_preview(spark, sf_dir):
    return quality.preview(quality.column_flags(_broken(spark, sf_dir), KEY), F.col("active") & ~F.col("profile_ok"), "cell_id")


@query("SELECT l_orderkey AS cell_id, count(*) AS n_levels, count(DISTINCT l_linenumber) AS n_distinct FROM lineitem GROUP BY 1 HAVING count(*) <> 4 OR count(DISTINCT l_linenumber) <> 4")
def level_count_check(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cell_id"), F.col("l_linenumber").alias("lev"))
    return quality.level_shape(li, KEY, 4)


# vertical

_HALF = (
    "WITH h AS (SELECT o_orderkey AS cell_id, k.lev, 800.0e0 * (20.0e0 - k.lev) - 100.0e0 * (o_orderkey % 3) AS hhl_m FROM orders CROSS JOIN (SELECT unnest(range(0, 21)) AS lev) k),"
    " n AS (SELECT *, 0.5e0 * (hhl_m + lead(hhl_m) OVER (PARTITION BY cell_id ORDER BY lev)) AS height_m FROM h), low AS (SELECT lev, min(height_m) AS low FROM n WHERE height_m IS NOT NULL GROUP BY lev)"
)


@query(f"{_HALF} SELECT CAST(coalesce(min(lev) FILTER (WHERE low <= 12000), min(lev)) AS INTEGER) AS first_lev, count(*) AS n_levels, count(*) - coalesce(min(lev) FILTER (WHERE low <= 12000), min(lev)) AS kept_levels FROM low")
def vertical_cutoff(spark, sf_dir):
    return vertical.level_selection(thermo.full_level_heights(fx.half_levels(spark, sf_dir), KEY))


@query(f"{_HALF} SELECT CAST(lev AS INTEGER) AS lev, count(*) AS n, round(sum(height_m), 3) AS height_sum FROM n WHERE height_m IS NOT NULL AND lev >= (SELECT coalesce(min(lev) FILTER (WHERE low <= 9000), min(lev)) FROM low) GROUP BY lev")
def level_prune(spark, sf_dir):
    full = thermo.full_level_heights(fx.half_levels(spark, sf_dir), KEY)
    return vertical.prune_levels(full, full, 9000.0).groupBy("lev").agg(F.count("*").alias("n"), F.round(F.sum("height_m"), 3).alias("height_sum"))


# catalogue

_CATALOG = "cat AS (SELECT strftime(ts, '%Y%m%d') AS run_date, event_type AS member, user_id % 3 AS param_id, CASE WHEN user_id % 3 = 1 THEN 'fs' ELSE 'none' END AS timespan, hour(ts) // 4 AS step, day(ts) % 2 + user_id % 5 AS lev FROM events)"
_CHECK = (
    f"WITH {_CATALOG}, e(param_id, param, timespan, levels) AS (VALUES (0, 'T', 'none', [0, 1, 2]), (1, 'TOT_PREC', 'fs', NULL), (2, 'T_G', 'none', NULL)),"
    " have AS (SELECT run_date, member, param_id, list(DISTINCT timespan) AS spans, list(DISTINCT step) AS steps, list(DISTINCT lev) AS levs FROM cat GROUP BY 1, 2, 3),"
    " x AS (SELECT r.run_date, r.member, e.param, coalesce(list_contains(spans, e.timespan), false) AS has_span, 6 - coalesce(len(list_filter(steps, lambda s: s BETWEEN 0 AND 5)), 0) AS missing_steps,"
    " CASE WHEN e.levels IS NULL THEN 0 ELSE len(list_filter(e.levels, lambda v: NOT coalesce(list_contains(levs, v), false))) END AS missing_levels"
    " FROM (SELECT DISTINCT run_date, member FROM cat) r CROSS JOIN e LEFT JOIN have ON r.run_date = have.run_date AND r.member = have.member AND e.param_id = have.param_id),"
    " chk AS (SELECT *, has_span AND missing_steps = 0 AND missing_levels = 0 AS complete FROM x)"
)
_RUN = ["run_date", "member"]


def _listed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A catalogue from events, and what is expected of its runs."""
    u = F.col("user_id")
    cat = fx.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("run_date"), F.col("event_type").alias("member"), (u % 3).cast("int").alias("param_id"), F.lit("any").alias("levtype"),
        F.when(u % 3 == 1, "fs").otherwise("none").alias("timespan"), F.floor(F.hour("ts") / 4).cast("int").alias("step"), (F.dayofmonth("ts") % 2 + u % 5).cast("int").alias("lev"),
    )
    steps = list(range(6))
    rows = [(0, "T", "any", "none", steps, [0, 1, 2]), (1, "TOT_PREC", "any", "fs", steps, None), (2, "T_G", "any", "none", steps, None)]
    expected = spark.createDataFrame(rows, "param_id int, param string, levtype string, timespan string, steps array<int>, levels array<int>")
    return cat, expected


def _checked(spark, sf_dir) -> DataFrame:
    cat, expected = _listed(spark, sf_dir)
    return catalog.completeness(cat, expected, _RUN)


@query(f"{_CHECK} SELECT run_date, member, param, has_span, CAST(missing_steps AS INTEGER) AS missing_steps, CAST(missing_levels AS INTEGER) AS missing_levels, complete FROM chk")
def run_completeness(spark, sf_dir):
    return _checked(spark, sf_dir).select(*_RUN, "param", "has_span", "missing_steps", "missing_levels", "complete")


@query(f"{_CHECK} SELECT run_date, member, param, has_span, CAST(missing_steps AS INTEGER) AS missing_steps, CAST(missing_levels AS INTEGER) AS missing_levels, complete FROM chk")
def bitmap_completeness(spark, sf_dir):
    """The same from a catalogue of bitmaps that grew day by day, was compacted, and was told some fields again."""
    cat, expected = _listed(spark, sf_dir)
    kept = bitmaps.BitmapCatalogue(spark, f"{shared_dir(spark)}/catalogue-{uuid.uuid4().hex}", _RUN)
    third = F.dayofmonth(F.to_date("run_date", "yyyyMMdd")) % 3
    for k in (0, 1, 2):
        kept.add(cat.where(third == k))
        if k == 1:
            kept.compact()
    kept.add(cat.where("step = 0"))
    return bitmaps.completeness(kept.table(), expected, _RUN).select(*_RUN, "param", "has_span", "missing_steps", "missing_levels", "complete")


@query(f"{_CHECK} SELECT member, max(run_date) AS run_date FROM (SELECT member, run_date FROM chk GROUP BY 1, 2 HAVING bool_and(complete)) GROUP BY member")
def latest_complete_run(spark, sf_dir):
    runs = catalog.complete_runs(_checked(spark, sf_dir), _RUN).withColumn("run_time", F.lit("0000"))
    return catalog.newest(runs, ["member"]).select("member", "run_date")


# monitoring

_SEEN = "seen AS (SELECT event_type AS member, (day(ts) - 1) * 24 + hour(ts) AS step FROM events WHERE event_type <> 'click' GROUP BY 1, 2)"


def _seen(spark, sf_dir) -> DataFrame:
    e = fx.table(spark, sf_dir, "events").where("event_type <> 'click'")
    return e.select(F.col("event_type").alias("member"), ((F.dayofmonth("ts") - 1) * 24 + F.hour("ts")).alias("step")).distinct()


@query(f"WITH {_SEEN} SELECT DISTINCT event_type AS member FROM events WHERE event_type NOT IN (SELECT member FROM seen WHERE member <> 'error') AND event_type <> 'error'")
def missing_results(spark, sf_dir):
    asked = fx.table(spark, sf_dir, "events").select(F.col("event_type").alias("member")).distinct()
    seen = _seen(spark, sf_dir)
    failed = spark.createDataFrame([("error",)], "member string")
    return monitoring.unaccounted(asked, seen.where("member <> 'error'"), failed)


@query(f"WITH {_SEEN}, w AS (SELECT m.member, s.step FROM (SELECT DISTINCT member FROM seen) m CROSS JOIN (SELECT unnest(range(0, 720)) AS step) s) SELECT w.member, CAST(w.step AS INTEGER) AS step FROM w ANTI JOIN seen USING (member, step)")
def missing_outputs(spark, sf_dir):
    seen = _seen(spark, sf_dir)
    return monitoring.missing_outputs(seen.select("member").distinct(), 719, seen)


_ALERTS = (
    f"WITH {_SEEN}, w AS (SELECT member, count(*) AS written FROM seen GROUP BY member), r AS (SELECT member, member = 'error' AS failed, count(DISTINCT day(ts)) AS steps, count(*) FILTER (WHERE value > 3 * (SELECT avg(value) FROM events)) AS bad"
    " FROM events WHERE event_type <> 'click' GROUP BY member), m(member) AS (SELECT DISTINCT event_type FROM events),"
    " a AS (SELECT member, 'failed_members' AS code FROM r WHERE failed UNION ALL SELECT member, 'incomplete_member_outputs' FROM r JOIN w USING (member) WHERE NOT failed AND (steps <> 720 OR written <> 720)"
    " UNION ALL SELECT member, 'fatal_data_quality' FROM r WHERE NOT failed AND bad > 0 UNION ALL SELECT member, 'missing_member_results' FROM m ANTI JOIN r USING (member)"
    " UNION ALL SELECT member, 'missing_output_files' FROM r JOIN w USING (member) WHERE NOT failed AND written < 720)"
    " SELECT code, count(*) AS n_members, string_agg(member, ',' ORDER BY member) AS members FROM a GROUP BY code UNION ALL SELECT 'wall_clock_exceeded', 0, '' FROM (SELECT sum(value) AS s FROM events) WHERE s > 1000"
).replace("member = 'error' AS failed", "event_type = 'error' AS failed").replace("(SELECT member, event_type", "(SELECT event_type AS member, event_type")


@query(_ALERTS)
def alerts(spark, sf_dir):
    """All six kinds: members are event types, steps their days, outputs their hours."""
    e = fx.table(spark, sf_dir, "events")
    limit = e.agg(F.avg("value").alias("mean"))
    bad = F.count_if(F.col("value") > 3 * F.col("mean")).alias(C.FATAL_COUNTERS[0])
    seen = _seen(spark, sf_dir)
    r = e.where("event_type <> 'click'").join(F.broadcast(limit)).groupBy(F.col("event_type").alias("member")).agg(F.countDistinct(F.dayofmonth("ts")).alias("steps"), bad)
    r = r.join(seen.groupBy("member").agg(F.count("*").alias("written")), "member").withColumn("failed", F.col("member") == "error")
    asked = e.select(F.col("event_type").alias("member")).distinct()
    return monitoring.alert_table(r, 720, asked=asked, written=seen, wall=e.agg(F.sum("value").alias("wall_s")), max_wall_s=1000.0)


# whole runs

_RUN_CODES = O.ptype(O.RUN_COLUMNS) + ", cells AS (SELECT lpad(CAST(cell_id // 1000000000 AS VARCHAR), 3, '0') AS member, CAST(cell_id % 1000000000 // 500000000 AS INTEGER) AS step, cell_id % 500000000 AS cell_id, ptype FROM codes) "


def _run_twice(spark, sf_dir) -> tuple[str, dict]:
    """A run over the derived store, done a second time with all its members at once: its outputs' root and its summary."""
    base = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    write_fields(fx.named(fx.run_parts(spark, sf_dir, pack=True)), f"{base}/store")
    config = RunConfig(fx.RUN["model"], fx.RUN_MEMBERS, fx.RUN_STEPS - 1, cutoff_m=9000.0, full_levels=fx.RUN_LEVELS)
    ask = {"run_date": fx.RUN["run_date"], "run_time": fx.RUN["run_time"], "check_outputs": True, "max_wall_s": 1e6}
    runs.run(spark, f"{base}/store", f"{base}/out", config, **ask)
    return f"{base}/out", runs.run(spark, f"{base}/store", f"{base}/out", config, **ask)


@query(_RUN_CODES + "SELECT member, step, CAST(cell_id AS BIGINT) AS cell_id, ptype, 502712 AS param_id FROM cells")
def run_outputs(spark, sf_dir):
    """Outputs after a run and its repetition, several members at a time: catalogue, fields, levels, blocks, gate and sink."""
    root, _ = _run_twice(spark, sf_dir)
    return read_categorical(spark, root).select("member", "step", "cell_id", "ptype", "param_id")


@query(
    "SELECT m.member, CASE WHEN m.member = '000' THEN 'cf' ELSE 'pf' END AS type, nullif(CAST(m.member AS INTEGER), 0) AS number, 2 AS steps, 2 AS written, 15 AS retained_full_levels, CAST(2 * count(*) AS BIGINT) AS total_columns,"
    " CAST(2 * count(*) FILTER (WHERE NOT (o_orderkey % 10 < 3) AND o_totalprice % 100.0e0 > 0) AS BIGINT) AS active_columns, CAST(0 AS BIGINT) AS invalid_profile_columns, 'ok' AS status, 0 AS recommended_exit_code"
    " FROM orders, (VALUES ('000'), ('001'), ('002')) m(member) GROUP BY m.member"
)
def run_summary(spark, sf_dir):
    """What the summary says of each member, and the monitoring of the run."""
    _, s = _run_twice(spark, sf_dir)
    status = s["monitoring"]
    rows = [
        (m, r["run"]["type"], r["run"]["number"], r["steps"], r["written"], r["retained_full_levels"], r["total_columns"], r["active_columns"], r["data_quality"]["invalid_profile_columns"], status["status"], status["recommended_exit_code"])
        for m, r in s["per_member"].items()
    ]
    kinds = "member string, type string, number int, steps int, written int, retained_full_levels int, total_columns long, active_columns long, invalid_profile_columns long, status string, recommended_exit_code int"
    return spark.createDataFrame(rows, kinds)


def _message_run(spark, sf_dir) -> str:
    """A run over the derived store kept as messages, with messages as outputs: the outputs' root."""
    base = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    write_field_parts(fx.named(fx.run_parts(spark, sf_dir)), f"{base}/store")
    config = RunConfig(fx.RUN["model"], fx.RUN_MEMBERS, fx.RUN_STEPS - 1, cutoff_m=9000.0, full_levels=fx.RUN_LEVELS)
    done = runs.run(spark, f"{base}/store", f"{base}/out", config, run_date=fx.RUN["run_date"], run_time=fx.RUN["run_time"], check_outputs=True, store_form="messages", messages=True)
    if done["failed"]:
        raise RuntimeError(str(done["failed"]))
    return f"{base}/out"


@query(_RUN_CODES + "SELECT member, step, CAST(cell_id AS BIGINT) AS cell_id, ptype, 502712 AS param_id FROM cells")
def message_roundtrip(spark, sf_dir):
    """Fields read from message files, codes written into each step's own message of precipitation, and those messages read back."""
    codes = read_codes(spark, runs.message_root(_message_run(spark, sf_dir)))
    cells = codes.select("member", "step", "at", F.posexplode("codes").alias("k", "ptype"))
    return cells.select("member", "step", (F.col("at") + F.col("k")).cast("long").alias("cell_id"), "ptype", F.lit(C.OUTPUT_PARAM).alias("param_id"))


@query(
    f"WITH {O.COLUMNS}, r AS (SELECT *, row_number() OVER (PARTITION BY lev ORDER BY cell_id) - 1 AS pos FROM levels WHERE lev BETWEEN 5 AND 8)"
    " SELECT 1 AS step, CAST(lev + 1 AS INTEGER) AS lev, CAST(pos AS INTEGER) AS pos, round(temperature_k + 2.0e0 - 1.5e0, 6) AS value FROM r"
)
def field_request(spark, sf_dir):
    """One parameter, step and range of levels of one member, from message files: filters go down to files and messages."""
    root = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    write_field_parts(fx.named(fx.run_parts(spark, sf_dir)), root)
    asked = MessageStore(spark, root).request(**fx.RUN, member="001", params=["T"], steps=(1, 1), levels=(6, 9))
    cells = asked.select("step", "lev", "at", F.posexplode("values").alias("k", "value"))
    return cells.select("step", "lev", (F.col("at") + F.col("k")).alias("pos"), F.round("value", 6).alias("value"))


@query(
    "WITH f AS (SELECT m.member, s.step, p.id AS param_id, l.lev FROM (VALUES ('000'), ('001'), ('002')) m(member), (VALUES (0), (1)) s(step), (VALUES (500014), (500001), (500035)) p(id), (SELECT unnest(range(1, 21)) AS lev) l"
    " UNION ALL SELECT m.member, s.step, p.id, 0 FROM (VALUES ('000'), ('001'), ('002')) m(member), (VALUES (0), (1)) s(step), (VALUES (500041), (500010)) p(id)"
    " UNION ALL SELECT m.member, 0, 500008, unnest(range(1, 22)) FROM (VALUES ('000'), ('001'), ('002')) m(member))"
    " SELECT member, CAST(step AS INTEGER) AS step, CAST(param_id AS INTEGER) AS param_id, CAST(lev AS INTEGER) AS lev, CASE WHEN param_id IN (500041, 500010) THEN 'sfc' ELSE 'ml' END AS levtype, CASE WHEN param_id = 500041 THEN 'fs' ELSE 'none' END AS timespan"
    " FROM f WHERE (SELECT count(*) FROM orders) > 0"
)
def message_catalogue(spark, sf_dir):
    """What a store of messages holds, from the heads of its messages."""
    root = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    write_field_parts(fx.named(fx.run_parts(spark, sf_dir)), root)
    return MessageStore(spark, root).catalogue().select("member", "step", "param_id", "lev", "levtype", "timespan")


def _derived_store(spark, sf_dir, fields: DataFrame) -> FieldStore:
    root = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    write_fields(fields, root)
    return FieldStore(spark, root)


@query(
    "WITH e AS (SELECT p.id AS param_id, s.step, l.lev FROM (VALUES (500014), (500001), (500035)) p(id), (SELECT unnest(range(0, 2)) AS step) s, (SELECT unnest(range(6, 21)) AS lev) l UNION ALL SELECT p.id, s.step, 0 FROM (VALUES (500041), (500010)) p(id), (SELECT unnest(range(0, 2)) AS step) s"
    " UNION ALL SELECT 500008, 0, unnest(range(6, 22))), n AS (SELECT *, CASE WHEN param_id = 500035 AND lev = 9 AND step = 1 THEN 0 WHEN param_id IN (500001, 500041) AND step = 0 THEN 2 ELSE 1 END AS n FROM e)"
    " SELECT param_id, CAST(step AS INTEGER) AS step, CAST(lev AS INTEGER) AS lev, CAST(n AS BIGINT) AS n FROM n WHERE n <> 1"
)
def field_count_check(spark, sf_dir):
    """Fields of a member that are missing (one) or repeated (a parameter's first step)."""
    parts = fx.run_parts(spark, sf_dir, ("001",), pack=True)
    lost = (F.col("param_id") == C.PARAMS["QV"]) & (F.col("lev") == 9) & (F.col("step") == 1)
    again = F.col("param_id").isin(C.PARAMS["P"], C.PARAMS["TOT_PREC"]) & (F.col("step") == 0)
    fields = parts.where(~lost).withColumn("copy", F.explode(F.when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    config = RunConfig(fx.RUN["model"], ("001",), fx.RUN_STEPS - 1, cutoff_m=9000.0, full_levels=fx.RUN_LEVELS)
    store = _derived_store(spark, sf_dir, fx.named(fields))
    _, first = runs.member_fields(store, config, "001", fx.RUN["run_date"], fx.RUN["run_time"])
    return blocks.field_counts(runs.member_keys(store, config, "001", fx.RUN["run_date"], fx.RUN["run_time"], first), runs.expected_fields(spark, config, first))


@query(
    "SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 50 WHEN 1 THEN o_orderkey % 50 WHEN 2 THEN o_orderkey % 30 ELSE o_orderkey % 30 END AS INTEGER) AS step FROM orders"
)
def field_steps(spark, sf_dir):
    """The end of a field's interval counts before its step, if it can be read."""
    k = F.col("o_orderkey")
    end = F.when(k % 4 == 0, (k % 50).cast("string")).when(k % 4 == 1, F.concat(((k % 50) * 60).cast("string"), F.lit("m"))).when(k % 4 == 2, F.lit("90m"))
    step = F.concat((k % 30).cast("string"), F.lit("h"))
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", tokens.field_step(end, step).alias("step"))


# sink checks and benchmark


@query("SELECT DISTINCT CAST(o_orderkey % 20 AS INTEGER) AS code FROM orders WHERE o_orderkey % 20 NOT IN (0, 1, 3, 5, 8, 12, 13)")
def validate_codes(spark, sf_dir):
    return validate.invalid_codes(fx.table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 20).alias("ptype")))


@query(O.ptype(O.synthetic(20_000, 80)) + " SELECT ptype, count(*) AS n, 15000 AS active_columns FROM codes GROUP BY ptype")
def benchmark_synthetic(spark, sf_dir):
    """Codes of the synthetic grid, with its active columns."""
    grid = synthetic_levels(spark, 20_000, 80)
    active = synthetic_arrays(spark, 20_000, 80).where("total_precip_mm > 0").count()
    return diagnose.categorical(grid, KEY).groupBy("ptype").agg(F.count("*").alias("n")).withColumn("active_columns", F.lit(active))


@query(O.ptype(O.synthetic(20_000, 80)) + " SELECT cell_id, ptype FROM codes")
def benchmark_synthetic_arrays(spark, sf_dir):
    return kernel.categorical_arrays(synthetic_arrays(spark, 20_000, 80), KEY)
