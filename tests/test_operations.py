"""Configuration, catalogue, monitoring, sinks, runs, quality gate, vertical cut, streaming, command line."""

import json

import pytest
from pyspark.sql import functions as F

from rimecast.__main__ import main, parser
from rimecast.functions import constants as C
from rimecast.functions import tokens
from rimecast.operators import quality, temporal, validate, vertical
from rimecast.operators.align import param_names
from rimecast.plans import catalog, monitoring, provenance
from rimecast.plans.config import RunConfig, parse_members
from rimecast.plans.run import run
from rimecast.sources.field_store import FieldStore, write_fields
from rimecast.sources.sinks import read_categorical, write_categorical, write_json
from rimecast.streaming.deaccumulate import replay


def test_members():
    assert parse_members("all", "CH1") == tuple(f"{i:03d}" for i in range(11))
    assert parse_members(" 001, 000,001", "CH1") == ("001", "000")
    for bad in ("", " , ", "1", "abc", "011"):
        with pytest.raises(ValueError):
            parse_members(bad, "CH1")


@pytest.mark.parametrize("bad", [{"model": "X"}, {"members": ()}, {"members": ("099",)}, {"max_step": -1}, {"chunk_size": 0}, {"workers": 0}, {"threshold_mm": -1.0}, {"threshold_mm": float("nan")}, {"cutoff_m": float("inf")}])
def test_config_rejects(bad):
    with pytest.raises(ValueError):
        RunConfig(**({"model": "CH1"} | bad))


def test_config_defaults():
    c = RunConfig("CH2")
    assert (len(c.members), c.max_step, c.threshold_mm, c.cutoff_m, c.chunk_size) == (21, 120, 0.0, 12000.0, 2)


def test_tokens(spark):
    df = spark.createDataFrame([("60m",), ("90m",), ("2h",), ("3",), ("4.9",), ("x",)], "s string")
    assert [r[0] for r in df.select(tokens.parse_step(F.col("s"))).collect()] == [1, None, 2, 3, 4, None]
    steps = spark.createDataFrame([(0,), (25,), (120,)], "s int")
    assert [r[0] for r in steps.select(tokens.step_token(F.col("s"))).collect()] == ["00000000", "01010000", "05000000"]
    gaps = spark.createDataFrame([(3, 3, 1), (3, 5, 3), (3, 6, 3)], "a int, b int, n int")
    assert [r[0] for r in gaps.select(tokens.step_range(F.col("a"), F.col("b"), F.col("n"))).collect()] == ["3", "3/to/5/by/1", None]


def test_unknown_parameter(spark):
    with pytest.raises(Exception, match="unknown parameter"):
        param_names(spark.createDataFrame([(1,)], "param_id int")).collect()


def test_deaccumulate_keeps_undefined_predecessors(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, None), (1, 2, 4.0), (1, 3, 9.0)], "cell_id int, step int, tot_prec double")
    got = [r["total_precip_mm"] for r in temporal.deaccumulate(df, ["cell_id"]).orderBy("step").collect()]
    assert got == [1.0, None, None, 5.0]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(c, s, float(s * s + c)) for c in range(3) for s in range(8)]
    df = spark.createDataFrame(rows, "cell_id int, step int, tot_prec double")
    want = {(r["cell_id"], r["step"]): r["total_precip_mm"] for r in temporal.deaccumulate(df, ["cell_id"]).collect()}
    got = {(r["cell_id"], r["step"]): r["total_precip_mm"] for r in replay(df, str(tmp_path), parts=4).collect()}
    assert got == want


def _heights(spark):
    return spark.createDataFrame([(c, k, h + 100 * c) for c in range(2) for k, h in enumerate([9000.0, 3000.0, 1000.0, 4000.0])], "cell_id int, lev int, height_m double")


@pytest.mark.parametrize(("cutoff", "first"), [(2500.0, 2), (3000.0, 1), (10.0, 0), (None, 0)])
def test_vertical_selection(spark, cutoff, first):
    assert tuple(vertical.level_selection(_heights(spark), cutoff).first()) == (first, 4, 4 - first)


def test_vertical_keeps_levels_below_the_start(spark):
    assert [r[0] for r in vertical.prune_levels(_heights(spark), _heights(spark), 2500.0).select("lev").distinct().orderBy("lev").collect()] == [2, 3]
    with pytest.raises(ValueError):
        vertical.level_selection(_heights(spark), float("nan"))


def _column(rain=1.0, ground=0.0, t=270.0):
    return [(0, 0, t, 9e4, 0.003, 500.0, rain, ground), (0, 1, 270.0, 9e4, 0.003, 100.0, rain, ground)]


_SCHEMA = "cell_id int, lev int, temperature_k double, pressure_pa double, specific_humidity double, height_m double, total_precip_mm double, ground_temperature_c double"


@pytest.mark.parametrize(("kw", "text"), [({"rain": float("nan")}, "precipitation"), ({"ground": float("inf")}, "ground"), ({"t": float("nan")}, "temperature")])
def test_gate(spark, kw, text):
    flags = quality.column_flags(spark.createDataFrame(_column(**kw), _SCHEMA), ["cell_id"])
    with pytest.raises(quality.DataQualityError, match=text):
        quality.gate(flags, "cell_id")


def test_gate_lets_dry_columns_pass(spark):
    flags = quality.column_flags(spark.createDataFrame(_column(rain=0.0, t=float("nan")), _SCHEMA), ["cell_id"])
    assert quality.gate(flags, "cell_id") == dict(zip(C.QUALITY_COUNTERS, (1, 0, 0, 0, 1, 0, 0), strict=True))


@pytest.mark.parametrize(("values", "match"), [([0.0, 5.0, float("nan")], "finite"), ([0.5], "whole"), ([2.0, 99.0], "2, 99"), ([0.0], "expected 3")])
def test_codes_rejected(spark, values, match):
    df = spark.createDataFrame([(v,) for v in values], "ptype double")
    with pytest.raises(ValueError, match=match):
        validate.check_codes(df, expected=3 if match == "expected 3" else None)


def test_categorical_sink(spark, tmp_path):
    df = spark.createDataFrame([("CH1", "20240101", "0000", "000", 0, c, c % 2) for c in range(4)], "model string, run_date string, run_time string, member string, step int, cell_id long, ptype int")
    write_categorical(df, str(tmp_path / "out"), expected=4)
    assert spark.read.parquet(str(tmp_path / "out")).where("ptype = 1 and param_id = 502712").count() == 2


def test_json_is_atomic(tmp_path):
    p = write_json({"b": 1, "a": [2]}, tmp_path / "x" / "s.json")
    assert p.read_text() == '{\n  "a": [\n    2\n  ],\n  "b": 1\n}\n'
    with pytest.raises(TypeError):
        write_json({"a": object()}, p)
    assert json.loads(p.read_text()) == {"a": [2], "b": 1}
    assert [f.name for f in p.parent.iterdir()] == ["s.json"]


def _summary(**more):
    base = {"members": ["000", "001"], "processed_members": ["000", "001"], "failed": {}, "max_step": 1, "data_quality": {}, "wall_s": 5.0}
    return base | {"per_member": {m: {"steps": 2, "written": 2} for m in ("000", "001")}} | more


@pytest.mark.parametrize(
    ("change", "kw", "codes"),
    [
        ({}, {}, []),
        ({"processed_members": ["000"], "failed": {"001": "x"}}, {}, ["failed_members"]),
        ({"processed_members": ["000"]}, {}, ["missing_member_results"]),
        ({"per_member": {"000": {"steps": 2, "written": 1}, "001": "?"}}, {}, ["incomplete_member_outputs"]),
        ({"data_quality": {"invalid_active_profile_columns": 2, "invalid_profile_columns": 9}}, {}, ["fatal_data_quality"]),
        ({}, {"max_wall_s": 5.0}, []),
        ({}, {"max_wall_s": 4.9}, ["wall_clock_exceeded"]),
        ({}, {"missing_outputs": [f"000/{i}" for i in range(12)]}, ["missing_output_files"]),
    ],
)
def test_alerts(change, kw, codes):
    got = monitoring.status(_summary(**change), **kw)
    assert [a["code"] for a in got["alerts"]] == codes
    assert got["recommended_exit_code"] == int(bool(codes)) and got["ok"] == (not codes)
    for a in got["alerts"]:
        if a["code"] == "missing_output_files":
            assert a["details"]["count"] == 12 and len(a["details"]["preview"]) == 10 and a["details"]["truncated"]


def test_provenance(spark, tmp_path):
    got = provenance.snapshot(spark, tmp_path)
    assert set(got) == {"engine", "session", "packages", "commit", "command"} and got["commit"] is None
    assert got["engine"]["spark"] == spark.version and got["session"]["master"] == spark.sparkContext.master
    (tmp_path / ".git" / "refs").mkdir(parents=True)
    (tmp_path / ".git" / "HEAD").write_text("ref: refs/main\n")
    assert provenance.commit_of(tmp_path) is None
    (tmp_path / ".git" / "packed-refs").write_text("# pack-refs\nabc123 refs/main\n")
    assert provenance.commit_of(tmp_path) == "abc123"
    (tmp_path / ".git" / "refs" / "main").write_text("def456\n")
    assert provenance.commit_of(tmp_path) == "def456"


LEVELS, CELLS, STEPS = 3, 4, 2


def _store(spark, root, members=("000", "001"), drop=None, again=None, cells=CELLS, ground=270.0):
    """A tiny store; ``drop`` leaves fields (member, parameter, step, level; None: any) out, ``again`` doubles them."""
    from rimecast.sources.field_store import SCHEMA

    rows, twice = [], []
    hit = lambda what, key: what is not None and all(w is None or w == k for w, k in zip(what, key, strict=True))

    def put(m, p, step, lev, values, levtype="ml", span="none"):
        row = (step, lev, levtype, span, values, "CH1", "20240101", "0000", m, C.PARAMS[p])
        if not hit(drop, (m, p, step, lev)):
            rows.append(row)
        if hit(again, (m, p, step, lev)):
            twice.append(row)

    for m in members:
        for k in range(LEVELS + 1):
            put(m, "HHL", 0, k + 1, [3000.0 * (LEVELS - k)] * cells)
        for s in range(STEPS):
            for k in range(LEVELS):
                put(m, "T", s, k + 1, [255.0 + 6 * k + c % 7 for c in range(cells)])
                put(m, "P", s, k + 1, [4e4 + 3e4 * k] * cells)
                put(m, "QV", s, k + 1, [0.001 + 0.0012 * k] * cells)
            put(m, "TOT_PREC", s, 0, [(0.0, 1.0 * (s + 1), 2.0 * (s + 1), 5.0)[c % 4] for c in range(cells)], "sfc", "fs")
            put(m, "T_G", s, 0, [ground if m == members[0] else 270.0] * cells, "sfc")
    write_fields(spark.createDataFrame(rows, SCHEMA), str(root))
    if twice:
        write_fields(spark.createDataFrame(twice, SCHEMA), str(root))


def _run(spark, tmp_path, members=("000", "001"), **more):
    config = RunConfig("CH1", members, STEPS - 1, full_levels=LEVELS, **more.pop("config", {}))
    return run(spark, str(tmp_path / "store"), str(tmp_path / "out"), config, run_date="20240101", run_time="0000", **more)


def _rows(spark, tmp_path):
    return sorted(map(tuple, read_categorical(spark, str(tmp_path / "out")).select("member", "step", "cell_id", "ptype").collect()))


def test_run_with_a_failing_member(spark, tmp_path):
    _store(spark, tmp_path / "store", drop=("001", "T_G", None, None))
    got = _run(spark, tmp_path, check_outputs=True, document_root=tmp_path / "docs")
    assert got["processed_members"] == ["000"] and "T_G" in got["failed"]["001"]
    assert got["per_member"]["000"]["written"] == STEPS and got["data_quality"]["total_columns"] == CELLS * STEPS
    assert got["per_member"]["000"]["run"] == {"date": "20240101", "time": "0000", "model": "CH1", "member": "000", "type": "cf", "number": None, "max_step": STEPS - 1}
    assert got["data_quality"]["active_columns"] == 3 + 2  # the last cell has no new rain in the second hour
    assert [a["code"] for a in got["monitoring"]["alerts"]] == ["failed_members"]
    out = _rows(spark, tmp_path)
    assert len(out) == CELLS * STEPS and sum(r[3] == 0 for r in out) == 3 and {r[0] for r in out} == {"000"}
    docs = tmp_path / "docs" / "CH1" / "20240101" / "0000"
    assert json.loads((docs / "summary.json").read_text())["monitoring"] == json.loads((docs / "monitoring.json").read_text())


def test_run_with_many_workers_and_again(spark, tmp_path):
    """All members at once give all rows; a second run gives the same; documents go beside the outputs; another member is left alone."""
    members = tuple(f"{i:03d}" for i in range(6))
    _store(spark, tmp_path / "store", members=members)
    got = _run(spark, tmp_path, members, config={"workers": 4}, check_outputs=True)
    assert got["failed"] == {} and got["monitoring"]["ok"] and got["workers"] == 4
    first = _rows(spark, tmp_path)
    assert len(first) == len(members) * STEPS * CELLS
    assert _run(spark, tmp_path, members, config={"workers": 4}, check_outputs=True)["monitoring"]["ok"] and _rows(spark, tmp_path) == first
    _run(spark, tmp_path, ("003",))
    assert _rows(spark, tmp_path) == first
    assert json.loads((tmp_path / "out/_documents/CH1/20240101/0000/summary.json").read_text())["members"] == ["003"]
    assert not list((tmp_path / "out" / "_staging").iterdir())


def test_failed_member_keeps_earlier_outputs_whole(spark, tmp_path):
    _store(spark, tmp_path / "store")
    _run(spark, tmp_path)
    first = _rows(spark, tmp_path)
    import shutil

    shutil.rmtree(tmp_path / "store")
    _store(spark, tmp_path / "store", ground=float("nan"))
    got = _run(spark, tmp_path)
    assert "ground temperature is not finite in active column(s): 0/1,0/2,0/3,1/1,1/2" in got["failed"]["000"] and got["processed_members"] == ["001"]
    assert _rows(spark, tmp_path) == first


@pytest.mark.parametrize(
    ("change", "match"),
    [({"drop": ("000", "QV", 1, 2)}, "QV step 1 level 2: expected 1 field, got 0"), ({"again": ("000", "P", 0, 3)}, "P step 0 level 3: expected 1 field, got 2"), ({"drop": ("000", "TOT_PREC", 1, None)}, "TOT_PREC step 1 level 0"), ({"again": ("000", "HHL", 0, 2)}, "HHL step 0 level 2")],
)
def test_run_counts_fields_exactly(spark, tmp_path, change, match):
    _store(spark, tmp_path / "store", members=("000",), **change)
    got = _run(spark, tmp_path, ("000",), check_inputs=False)
    assert match in got["failed"]["000"] and got["processed_members"] == []


def test_run_takes_the_last_of_repeated_surface_fields(spark, tmp_path):
    _store(spark, tmp_path / "store", members=("000",), again=("000", "TOT_PREC", None, None))
    got = _run(spark, tmp_path, ("000",))
    assert got["failed"] == {} and len(_rows(spark, tmp_path)) == CELLS * STEPS


def test_blocks_agree_with_long_levels(spark, tmp_path):
    """Many blocks of cells give what the levels of each cell give on the other path."""
    from rimecast.operators import blocks, diagnose

    cells = 2500
    _store(spark, tmp_path / "store", members=("000",), cells=cells)
    assert _run(spark, tmp_path, ("000",))["failed"] == {}
    got = _rows(spark, tmp_path)
    assert len(got) == cells * STEPS and blocks.BLOCK < cells
    rows = [(s, c, k, 255.0 + 6 * k + c % 7, 4e4 + 3e4 * k, 0.001 + 0.0012 * k, 3000.0 * (LEVELS - k - 0.5), (0.0, 1.0, 2.0, 5.0 if s == 0 else 0.0)[c % 4], 270.0 - 273.15) for s in range(STEPS) for c in range(28) for k in range(LEVELS)]
    long = diagnose.categorical(spark.createDataFrame(rows, "step int, cell_id int, lev int, temperature_k double, pressure_pa double, specific_humidity double, height_m double, total_precip_mm double, ground_temperature_c double"), ["step", "cell_id"])
    want = {(r["step"], r["cell_id"]): r["ptype"] for r in long.collect()}
    assert all(code == want[(step, cell % 28)] for _, step, cell, code in got)


def test_messages(spark, tmp_path):
    from rimecast.sources.sinks import write_messages

    df = spark.createDataFrame([("CH1", "20240101", "0000", "000", s, c, c % 2) for s in (0, 25) for c in range(4)], "model string, run_date string, run_time string, member string, step int, cell_id long, ptype int")
    templates = spark.createDataFrame([("CH1", [2, 2], bytearray(b"head:"))], "model string, shape array<int>, message binary")
    encode = lambda t, codes: t.message + bytes(codes)
    done = {r["step"]: (r["path"], r["cells"]) for r in write_messages(df, str(tmp_path), templates, encode).collect()}
    assert done[25] == (str(tmp_path / "CH1/20240101/0000/000/lfff01010000.ptype.grib2"), 4)
    assert (tmp_path / "CH1/20240101/0000/000/lfff00000000.ptype.grib2").read_bytes() == b"head:\x00\x01\x00\x01"
    with pytest.raises(Exception, match="don't fill"):
        write_messages(df, str(tmp_path), templates.withColumn("shape", F.array(F.lit(3))), encode).collect()


def test_missing_parameter_at_a_level_is_an_error(spark):
    from rimecast.operators.align import align_levels

    rows = [(c, k, C.PARAMS[p], 1.0) for c in range(2) for k in range(2) for p in ("T", "P", "QV") if (c, k, p) != (1, 1, "P")]
    with pytest.raises(Exception, match="P: expected 1 value, got 0 at cell_id 1, lev 1"):
        align_levels(spark.createDataFrame(rows, "cell_id int, lev int, param_id int, value double"), ["cell_id"]).collect()


def test_discovery(spark, tmp_path):
    _store(spark, tmp_path / "s")
    store = FieldStore(spark, str(tmp_path / "s"))
    cat = store.catalogue()
    with pytest.raises(RuntimeError, match="no complete run"):
        catalog.discover(cat, model="CH1", member="000", max_step=1, lookback_days=2, full=LEVELS, half=LEVELS + 1)
    today = spark.range(1).select(F.date_format(F.current_date(), "yyyyMMdd")).first()[0]
    now = cat.withColumn("run_date", F.lit(today))
    assert catalog.discover(now, model="CH1", member="000", max_step=1, lookback_days=2, full=LEVELS, half=LEVELS + 1) == (today, "0000")
    with pytest.raises(RuntimeError, match="TOT_PREC"):
        catalog.check_complete(cat, model="CH1", run_date="20240101", run_time="0000", member="000", max_step=5, full=LEVELS, half=LEVELS + 1)


@pytest.mark.parametrize("extra", [["--date", "20240101"], ["--max-wall-s", "0"], ["--members", "x"], ["--max-step", "-1"], ["--chunk-size", "0"], ["--workers", "0"]])
def test_command_line_rejects(extra):
    with pytest.raises(SystemExit) as x:
        main(["--model", "CH1", "--store", "s", "--output-root", "o", *extra])
    assert x.value.code == 2


def test_command_line_defaults():
    a = parser().parse_args(["--model", "CH2", "--store", "s", "--output-root", "o"])
    assert (a.members, a.lookback_days, a.chunk_size, a.workers, a.vertical_cutoff_m) == ("all", 2, 2, 4, 12000.0)


def test_definition_path():
    from rimecast.sources.definitions import executor_settings, search_path

    there = {"/own", "/pkg", "/tmp/a", "/over"}.__contains__
    assert search_path(None, installed=["/pkg", "/none", "/pkg"], fallbacks=["/tmp/a"], overlay="/over", exists=there) == "/over:/pkg:/tmp/a"
    once = search_path("/pkg:/else", override="/own:/gone", overlay="/over", exists=there)
    assert once == "/over:/own:/pkg:/else" and search_path(once, override="/own:/gone", overlay="/over", exists=there) == once
    assert search_path(None, exists=there) is None and executor_settings("DEFS", None) == {}
    assert executor_settings("DEFS", "/a") == {"spark.executorEnv.DEFS": "/a"}


def test_rates():
    from rimecast.functions.rates import columns_per_second

    assert columns_per_second(10, 4.0) == 2.5 and columns_per_second(10, 0.0) == 0.0


def test_held_steps_are_released_in_order_or_given_up():
    import numpy as np

    from rimecast.streaming.deaccumulate import released

    last, value, out, steps, values = released(-1, 0.0, np.array([0, 1, 3]), np.array([1.0, 4.0, 9.0]), 0)
    assert (last, value, out.tolist(), steps.tolist()) == (1, 4.0, [1.0, 3.0], [3])
    assert len(released(last, value, steps, values, 0)[2]) == 0
    last, value, out, steps, _ = released(last, value, steps, values, 0, give_up=True)
    assert last == 3 and value == 9.0 and np.isnan(out).tolist() == [True] and not len(steps)
