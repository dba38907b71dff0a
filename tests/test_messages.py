"""Messages: the codec against values and broken bytes, the source's pushed filters, the sink's commits, runs over messages."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds

from rimecast.functions import constants as C
from rimecast.operators import blocks
from rimecast.plans.config import RunConfig
from rimecast.plans.run import message_root, run
from rimecast.sources import field_source as fs
from rimecast.sources import messages as m
from rimecast.sources.field_store import SCHEMA
from rimecast.sources.sinks import commit_messages, read_categorical, read_messages, write_categorical, write_json

WHEN = {"run_date": "20240229", "run_time": "0600", "member": "003"}
RNG = np.random.default_rng(11)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 7, 8, 9, 12, 16, 17, 24, 31, 32, 33, 63, 64])
def test_bits_come_back(bits):
    for n in (0, 1, 7, 8, 9, 1000, m._PIECE + 3):
        numbers = RNG.integers(0, (1 << bits) - 1, n, dtype=np.uint64, endpoint=True)
        packed = m.pack_bits(numbers, bits)
        assert len(packed) == (n * bits + 7) // 8 and (m.unpack_bits(packed, bits, n) == numbers).all()


def test_bits_are_in_order():
    assert m.pack_bits(np.array([5, 2, 7]), 3) == bytes([0b10101011, 0b10000000])
    with pytest.raises(m.MessageError, match="doesn't fit"):
        m.pack_bits(np.array([8]), 3)
    with pytest.raises(m.MessageError, match="hold less than"):
        m.unpack_bits(b"\x00", 3, 3)


@pytest.mark.parametrize("shape", [None, (60,), (5, 12), (60, 1)])
@pytest.mark.parametrize("param", [*m.PRODUCTS])
def test_fields_come_back(param, shape):
    values = RNG.normal(280, 20, 60)
    lev = 7 if m.PRODUCTS[param][2] == m._LEVEL else 0
    message = m.field_message(param, values, **WHEN, step=25, lev=lev, shape=shape)
    keys = m.keys_of(message)
    assert (m.values_of(message) == values).all() and m.shape_of(message) == (shape or (60,))
    assert m.parameter_of(keys) == param and (keys["step"], keys["lev"], keys["member"], keys["run_date"], keys["run_time"]) == (25, lev, 3, "20240229", "0600")
    codes = RNG.choice([*C.CODE_NAMES], 60)
    output = m.refill(message, codes)
    assert (m.values_of(output) == codes).all() and m.shape_of(output) == m.shape_of(message)
    again = m.keys_of(output)
    assert m.parameter_of(again) == C.OUTPUT_NAME and {k: v for k, v in again.items() if k not in ("category", "number")} == {k: v for k, v in keys.items() if k not in ("category", "number")}
    assert [x for x in m.sections(output)][1][0] == m.GRID and output[: 4] == b"GRIB" and struct.unpack_from(">Q", output, 8) == (len(output),)


@pytest.mark.parametrize("bits", [1, 4, 12, 16, 24, 40])
def test_packing_is_as_close_as_its_bits(bits):
    values = RNG.normal(0, 1e4, 777)
    got = m.values_of(m.field_message("P", values, **WHEN, step=0, lev=1, bits=bits))
    step = 2.0 ** np.ceil(np.log2(np.ptp(values) * 1.0001 / ((1 << bits) - 1)))
    assert np.abs(got - values).max() <= step / 2 + 1e-9


def test_packing_decimal_and_negative_scales():
    p = m.Packing.of(np.array([0.25, 1.75, -3.0]), decimal=2)
    assert p.bits == 9 and (p.unpack(p.pack(np.array([0.25, 1.75, -3.0])), 3) == [0.25, 1.75, -3.0]).all()
    assert m._signed(m._with_sign(-5, 16), 16) == -5 and m._signed(m._with_sign(5, 16), 16) == 5
    with pytest.raises(m.MessageError, match="not whole numbers"):
        m.Packing.of(np.array([0.5]))


@pytest.mark.parametrize("values", [[], [0.0], [13.0] * 9, [np.nan] * 3, [1.0, np.nan, 3.0, np.nan, np.nan, 6.0, 7.0, 8.0, np.nan]])
def test_constant_empty_and_undefined_fields(values):
    for bits in (None, 10):
        got = m.values_of(m.field_message("T_G", np.array(values), **WHEN, step=3, bits=bits))
        assert np.allclose(got, values, atol=0.01, equal_nan=True)


def _broken():
    good = m.field_message("T", np.arange(10.0), **WHEN, step=1, lev=2, bits=8)
    change = lambda at, new: good[:at] + new + good[at + len(new) :]
    at = {n: b for n, b, _ in m.sections(good)}
    end = {n: e for n, _, e in m.sections(good)}
    twice = good[: at[m.REPRESENTATION]] + good[at[m.REPRESENTATION] : -4] * 2 + b"7777"
    return {
        "not a message": b"GRAB" + good[4:],
        "edition 1": change(7, b"\x01"),
        "expected": good[:-1],
        "occurs twice": twice[:8] + struct.pack(">Q", len(twice)) + twice[16:],
        "doesn't fit": change(at[m.GRID], struct.pack(">I", 1 << 20)),
        "missing": m._whole(0, [good[at[k] : end[k]] for k in at if k != m.BITMAP]),
        "representation 40": change(at[m.REPRESENTATION] + 9, struct.pack(">H", 40)),
        "values for 10 points": change(at[m.REPRESENTATION] + 5, struct.pack(">I", 9)),
        "hold less": change(at[m.REPRESENTATION] + 19, b"\x20"),
        "bitmap of kind 254": change(at[m.BITMAP] + 5, b"\xfe"),
    }


@pytest.mark.parametrize("said", [*_broken()])
def test_broken_messages_are_errors(said):
    with pytest.raises(m.MessageError, match=said):
        m.values_of(_broken()[said])


def test_codes_must_fill_the_grid():
    with pytest.raises(m.MessageError, match="3 codes don't fill"):
        m.refill(m.field_message("TOT_PREC", np.zeros(4), **WHEN, step=1, shape=(2, 2)), np.zeros(3))


# the source

LEVELS, CELLS, STEPS = 3, 6, 2
ASK = {"model": "CH1", "run_date": "20240101", "run_time": "0000"}


def _fields(spark, members=("000", "001")):
    rows = []
    for member in members:
        put = lambda p, step, lev, values, levtype="ml", span="none", member=member: rows.append((step, lev, levtype, span, values, "CH1", "20240101", "0000", member, C.PARAMS[p]))
        for k in range(LEVELS + 1):
            put("HHL", 0, k + 1, [3000.0 * (LEVELS - k)] * CELLS)
        for s in range(STEPS):
            for k in range(LEVELS):
                put("T", s, k + 1, [255.0 + 6 * k + c for c in range(CELLS)])
                put("P", s, k + 1, [4e4 + 3e4 * k] * CELLS)
                put("QV", s, k + 1, [0.001 + 0.0012 * k] * CELLS)
            put("TOT_PREC", s, 0, [(0.0, 1.0 * (s + 1), 2.0 * (s + 1))[c % 3] for c in range(CELLS)], "sfc", "fs")
            put("T_G", s, 0, [270.0] * CELLS, "sfc")
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("messages") / "store"
    fs.write_field_files(_fields(spark), str(root), shape=(2, 3))
    return fs.MessageStore(spark, str(root))


def _bag(df):
    names = ["member", "param_id", "step", "lev", "levtype", "timespan", "values"]
    return sorted(tuple(map(str, r)) for r in df.select(*names).collect())


def test_the_source_gives_what_was_written(spark, store):
    assert _bag(store.scan()) == _bag(_fields(spark))
    assert store.catalogue().count() == _fields(spark).count()


def test_filters_are_pushed(spark, store):
    asked = store.request(**ASK, member="001", params=["T", "P"], steps=(1, 1), levels=(2, 3))
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "Filter " not in plan.replace("PushedFilters", "")
    want = _fields(spark).where("member = '001' and param_id in (500014, 500001) and step = 1 and lev between 2 and 3")
    assert _bag(asked) == _bag(want)
    odd = store.scan().where((F.col("lev") == 2) | (F.size("values") > 100)).where("lev <> 3 and member > '000'")
    assert _bag(odd) == _bag(_fields(spark).where("lev = 2 and member = '001'"))
    assert store.request(**ASK, member="009", params=["T"]).count() == 0
    assert store.scan().where("timespan = 'fs' and levtype in ('sfc', 'x')").count() == 2 * STEPS


def test_a_request_for_one_level_reads_only_its_messages(store, monkeypatch):
    opened, read = [], []

    class Counted:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *x):
            self.f.close()

        def size(self):
            return self.f.size()

        def read_at(self, n, at):
            read.append((n, at))
            return self.f.read_at(n, at)

    class Store:
        def __init__(self, inner):
            self.inner = inner

        def get_file_info(self, x):
            return self.inner.get_file_info(x)

        def open_input_file(self, path):
            opened.append(path)
            return Counted(self.inner.open_input_file(path))

    plain = fs.file_system
    monkeypatch.setattr(fs, "file_system", lambda root: (Store(plain(root)[0]), plain(root)[1]))
    monkeypatch.setattr(fs, "HEAD", 200)
    reader = fs.FieldReader({"root": f"file://{store.root}"})
    left = list(reader.pushFilters([ds.EqualTo(("param_id",), C.PARAMS["T"]), ds.EqualTo(("step",), 1), ds.EqualTo(("member",), "000"), ds.EqualTo(("lev",), 2), ds.StringContains(("model",), "H")]))
    assert [type(f) for f in left] == [ds.StringContains]
    parts = reader.partitions()
    assert [p.path for p in parts] == [f"{store.root}/CH1/20240101/0000/000/{C.PARAMS['T']}/00001.fields"] and not opened
    batches = [b for p in parts for b in reader.read(p)]
    assert opened == [parts[0].path] and [b.num_rows for b in batches] == [1]
    whole = [n for n, _ in read if n > 200]
    assert len(whole) == 1  # one message in full, of the others only the head


def test_broken_and_misplaced_files_are_errors(spark, store, tmp_path):
    import shutil

    root = tmp_path / "store"
    shutil.copytree(store.root, root)
    folder = root / "CH1/20240101/0000/000" / str(C.PARAMS["T"])
    good = (folder / "00001.fields").read_bytes()
    for content, said in ((good[:-3], "doesn't fit"), (b"x" * 40 + good, "no message at byte 0"), ((root / "CH1/20240101/0000/000" / str(C.PARAMS["P"]) / "00001.fields").read_bytes(), "holds P of step 1"), ((folder / "00000.fields").read_bytes(), "holds T of step 0")):
        (folder / "00001.fields").write_bytes(content)
        broken = fs.MessageStore(spark, str(root))
        with pytest.raises(Exception, match=said):
            broken.scan().collect()
        assert broken.scan().where("step = 0").count() == broken.scan("keys").where("step = 0").count()
    (folder / "00001.fields").write_bytes(b"")
    assert fs.MessageStore(spark, str(root)).request(**ASK, member="000", params=["T"], steps=(1, 1)).count() == 0
    with pytest.raises(ValueError, match="content is"):
        fs.source_schema("all")


def test_an_empty_store(spark, tmp_path):
    assert fs.MessageStore(spark, str(tmp_path / "none")).scan().count() == 0


# the sink


def _files(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.is_file() and not p.name.startswith(".")}


def _rows(spark, rows):
    return spark.createDataFrame([(p, k, bytearray(c)) for k, (p, c) in enumerate(rows)], "path string, part int, content binary")


def test_files_are_committed_whole(spark, tmp_path):
    rows = [(f"d{k % 3}/f{k % 7}", bytes([k]) * 5) for k in range(40)]
    fs.write_files(_rows(spark, rows).repartition(8), str(tmp_path))
    want = {}
    for p, c in rows:
        want[p] = want.get(p, b"") + c
    assert _files(tmp_path) == want
    fs.write_files(_rows(spark, [("d0/f0", b"new"), ("e", b"")]), str(tmp_path))
    assert _files(tmp_path) == want | {"d0/f0": b"new", "e": b""}


def test_a_task_that_dies_half_way_leaves_the_old_files(spark, tmp_path):
    fs.write_files(_rows(spark, [("a", b"old"), ("b", b"old")]), str(tmp_path))

    @F.udf("binary")
    def dies(path, content):
        if path == "b":
            raise RuntimeError("killed")
        return content

    rows = _rows(spark, [("a", b"new"), ("b", b"new"), ("c", b"new")]).repartition(3, "path")
    with pytest.raises(Exception, match="killed"):
        rows.select("path", dies("path", "content").alias("content")).write.format(fs.FILES).option("root", f"file://{tmp_path}").mode("append").save()
    assert _files(tmp_path) == {"a": b"old", "b": b"old"}


def test_repeated_attempts_commit_once(tmp_path):
    """Two attempts of one task both finish; only the one that Spark names is committed, the other's files go."""
    import pyarrow as pa

    writer = fs.FileWriter({"root": f"file://{tmp_path}"})
    batch = lambda c: [pa.RecordBatch.from_arrays([pa.array(["x/a", "x/a", "x/b"]), pa.array([c, c, c], pa.binary())], ["path", "content"])]
    lost, named = writer.write(iter(batch(b"1"))), writer.write(iter(batch(b"2")))
    assert _files(tmp_path).keys() == {f"_staging/{writer.job}/{s.folder.rsplit('/', 1)[1]}/x/{n}" for s in (lost, named) for n in "ab"}
    writer.commit([named, None])
    assert _files(tmp_path) == {"x/a": b"22", "x/b": b"2"}


def test_a_commit_checks_before_it_moves(tmp_path):
    import pyarrow as pa

    rows = lambda *p: iter([pa.RecordBatch.from_arrays([pa.array(p), pa.array([b"1"] * len(p), pa.binary())], ["path", "content"])])
    writer = fs.FileWriter({"root": f"file://{tmp_path}"})
    one, two = writer.write(rows("a", "b")), writer.write(rows("c", "b"))
    with pytest.raises(ValueError, match="b was written by two tasks"):
        writer.commit([one, two])
    lost = writer.write(rows("d"))
    lost.files["d"] = 5
    with pytest.raises(OSError, match="expected 5"):
        writer.commit([one, lost])
    writer.abort([one, two, lost])
    assert _files(tmp_path) == {}
    for bad in (("a", "b", "a"), ("/x",), ("a/../b",), ("",)):
        with pytest.raises(ValueError, match="no path"):
            writer.write(rows(*bad))
    assert _files(tmp_path) == {}


# runs

OUT = "model string, run_date string, run_time string, member string, step int, cell_id long, ptype int"


def test_a_run_over_messages(spark, store, tmp_path):
    config = RunConfig("CH1", ("000", "001"), STEPS - 1, full_levels=LEVELS)
    done = run(spark, store.root, str(tmp_path), config, run_date="20240101", run_time="0000", store_form="messages", messages=True)
    assert done["failed"] == {} and done["monitoring"]["ok"]
    tables = read_categorical(spark, str(tmp_path)).select("member", "step", "cell_id", "ptype")
    codes = read_messages(spark, message_root(str(tmp_path)))
    assert {(r["model"], r["run_date"], r["run_time"]) for r in codes.collect()} == {("CH1", "20240101", "0000")}
    cells = codes.select("member", "step", F.posexplode("codes").alias("cell_id", "ptype"))
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, tables.collect()))
    one = (tmp_path / "_messages/CH1/20240101/0000/001/lfff00010000.ptype.grib2").read_bytes()
    keys = m.keys_of(one)
    assert m.shape_of(one) == (2, 3) and (keys["step"], keys["member"], m.parameter_of(keys)) == (1, 1, C.OUTPUT_NAME)
    with pytest.raises(ValueError, match="messages are made from"):
        run(spark, store.root, str(tmp_path), config, run_date="20240101", run_time="0000", messages=True)


def test_messages_need_their_own_template(spark, tmp_path):
    whole = spark.createDataFrame([("CH1", "20240101", "0000", "000", s, [0, 1, 5, 3]) for s in (0, 1)], "model string, run_date string, run_time string, member string, step int, codes array<int>")
    own = lambda s: bytearray(m.field_message("TOT_PREC", np.zeros(4), run_date="20240101", run_time="0000", member="000", step=s))
    templates = spark.createDataFrame([("000", s, own(s)) for s in (0, 1)], "member string, step int, message binary")
    assert commit_messages(whole, str(tmp_path), templates) == 2
    assert {r["step"]: r["codes"] for r in read_messages(spark, str(tmp_path)).collect()} == {0: [0, 1, 5, 3], 1: [0, 1, 5, 3]}
    before = _files(tmp_path)
    with pytest.raises(Exception, match="no template for CH1/20240101/0000/000/lfff00010000"):
        commit_messages(whole.withColumn("codes", F.array(*[F.lit(1)] * 4)), str(tmp_path), templates.where("step = 0"))
    assert _files(tmp_path) == before


def test_step_codes_are_in_the_order_of_cells(spark):
    rows = [(s, b, [s * 100 + b * 3 + k for k in range(3 if b < 2 else 1)]) for s in range(2) for b in (2, 0, 1)]
    got = blocks.step_codes(spark.createDataFrame(rows, "step int, block int, ptype array<int>"))
    assert {r["step"]: r["codes"] for r in got.collect()} == {s: [s * 100 + k for k in range(7)] for s in range(2)}


def test_few_files_per_step(spark, tmp_path):
    """The number of files follows from the cells of a step, not from the tasks that hold them."""
    rows = [("CH1", "20240101", "0000", "000", s, c, 0) for s in range(12) for c in range(40)]
    write_categorical(spark.createDataFrame(rows, OUT).repartition(8), str(tmp_path / "out"), expected=480)
    files = [p for p in (tmp_path / "out").rglob("*.parquet")]
    assert len(files) == 12 and read_categorical(spark, str(tmp_path / "out")).count() == 480


def test_documents_are_on_the_file_system_of_the_outputs(spark, tmp_path):
    """With a session, JSON goes through Hadoop whatever the form of the path, and replaces what was there at once."""
    for k, place in enumerate((tmp_path / "a/s.json", f"file://{tmp_path}/b/s.json")):
        for n in (1, 2):
            write_json({"n": n}, place, spark)
        assert (tmp_path / "ab"[k] / "s.json").read_text() == '{\n  "n": 2\n}\n'
        assert [p.name for p in (tmp_path / "ab"[k]).iterdir() if not p.name.startswith(".")] == ["s.json"]
