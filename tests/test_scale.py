"""What queries exchange and hold when their tables come in many files."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rimecast.plans.queries import QUERIES


@pytest.fixture(scope="module")
def many_files(spark, sf, tmp_path_factory):
    """Orders in more files than there are cores."""
    folder = str(tmp_path_factory.mktemp("many"))
    spark.read.parquet(f"{sf}/orders.parquet").repartition(8).write.parquet(f"{folder}/orders.parquet")
    return folder


def exchanged_levels(df) -> list[str]:
    """Exchanges of the plan that have rows exploded to levels below them."""
    above, found = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(re.match(r"[\s:+\-*()\d]*", line)[0])
        above = [(d, text) for d, text in above if d < depth] + [(depth, line)]
        if " Generate " in f" {line[depth:]}":
            found += [text for _, text in above if text.lstrip(" :+-*()0123456789").startswith("Exchange")]
    return found


@pytest.mark.parametrize("name", ["align_params", "type_probabilities", "ptype_grid", "surface_up_energies", "full_level_heights"])
def test_columns_are_exchanged_not_their_levels(spark, many_files, name):
    df = QUERIES[name](spark, many_files)
    assert "Generate" in df._jdf.queryExecution().executedPlan().toString()
    assert exchanged_levels(df) == []


def test_fields_are_cut_and_put_together_without_going_through_them_cell_by_cell(spark, many_files):
    from rimecast.operators.blocks import field_blocks
    from rimecast.sources import fixtures as fx

    made = fx.run_fields(spark, many_files)
    # what is exchanged are blocks of cells, not a row per cell of each field
    assert not re.search(r"collect_list\((named_)?struct\(cell_id, cell_id#\w+, value", made._jdf.queryExecution().executedPlan().toString())
    values = [float(k) for k in range(2500)]
    rows = spark.createDataFrame([(500008, 0, 1, values), (500014, 3, 2, values[:1024]), (500014, 3, 3, [])], "param_id int, step int, lev int, values array<double>")
    cut = field_blocks(rows)
    assert "slice(" not in cut._jdf.queryExecution().executedPlan().toString()
    got = {(r["param_id"], r["step"], r["lev"], r["block"]): r["values"] for r in cut.collect()}
    assert got == {(500008, -1, 1, k): values[k * 1024 : (k + 1) * 1024] for k in range(3)} | {(500014, 3, 2, 0): values[:1024]}


def test_the_table_function_takes_many_columns_at_once(spark):
    from pyspark.sql import functions as F

    from rimecast.functions.sql_tables import PROFILE, SURFACE, register_tables
    from rimecast.sources.synthetic import synthetic_levels

    register_tables(spark)
    levels = synthetic_levels(spark, 60, 20).withColumn("total_precip_mm", F.when(F.col("cell_id") != 5, F.col("total_precip_mm")))
    one = spark.sql("SELECT cell_id, ptype FROM diagnose(TABLE({levels}) PARTITION BY cell_id ORDER BY lev)", levels=levels)
    names = ["cell_id", *PROFILE, *SURFACE]
    rows = levels.groupBy((F.col("cell_id") % 4).alias("block"), "lev").agg(F.sort_array(F.collect_list(F.struct(*[F.coalesce(c, F.lit(float("nan"))).alias(c) if c != "cell_id" else F.col(c) for c in names]))).alias("c"))
    side = rows.select("block", "lev", *[F.col(f"c.{c}").alias(c) for c in names])
    many = spark.sql("SELECT explode(arrays_zip(cell_id, ptype)) AS c FROM diagnose(TABLE({levels}) PARTITION BY block ORDER BY lev)", levels=side).select("c.*")
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect())) and one.where("ptype > 0").count()


@pytest.mark.parametrize("name", ["deaccumulate", "accumulated"])
def test_users_are_exchanged_not_their_dense_hours(spark, sf, tmp_path, name):
    from rimecast.sources import fixtures as fx

    spark.read.parquet(f"{sf}/events.parquet").repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    df = fx.accumulated(spark, str(tmp_path)) if name == "accumulated" else QUERIES[name](spark, str(tmp_path))
    assert "Generate" in df._jdf.queryExecution().executedPlan().toString()
    assert exchanged_levels(df) == []


@pytest.fixture(scope="module")
def many_cells(spark, sf, tmp_path_factory):
    """Orders of some 300,000 cells."""
    folder = str(tmp_path_factory.mktemp("cells"))
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    n = orders.count()
    more = orders.crossJoin(spark.range(200).withColumnRenamed("id", "copy")).withColumn("o_orderkey", orders["o_orderkey"] + n * F.col("copy")).drop("copy")
    more.write.parquet(f"{folder}/orders.parquet")
    return folder


def _stored(spark, name: str, before: set) -> tuple[str, int]:
    """The new store of a query, and its bytes."""
    (new,) = [p for p in _stores(spark, name) if p not in before]
    return new, sum(p.stat().st_size for p in Path(new).rglob("*") if p.is_file())


def _stores(spark, name: str) -> set:
    from rimecast.scratch import shared_dir

    return {str(p) for p in Path(shared_dir(spark).removeprefix("file://")).glob(name)}


def test_field_request_reads_large_fields_in_parts(spark, many_cells):
    """no row of a store of messages holds a whole large field."""
    from rimecast.sources.field_source import PART, MessageStore

    before = _stores(spark, "store-*")
    df = QUERIES["field_request"](spark, many_cells)
    store, _ = _stored(spark, "store-*", before)
    longest, cells = MessageStore(spark, store).scan().where("param_id = 500014 and member = '001' and lev = 7 and step = 1").agg(F.max(F.size("values")), F.sum(F.size("values"))).first()
    assert longest <= PART < cells
    n, low, high, different = df.agg(F.count("*"), F.min("pos"), F.max("pos"), F.countDistinct("lev", "pos")).first()
    assert (n, low, high, different) == (4 * cells, 0, cells - 1, 4 * cells)


def test_message_catalogue_keeps_messages_compressed(spark, many_cells):
    """messages of all fields take a small part of their values' bytes, and none is put together in a task."""
    before = _stores(spark, "store-*")
    df = QUERIES["message_catalogue"](spark, many_cells)
    assert df.count() == 435
    _, size = _stored(spark, "store-*", before)
    cells = spark.read.parquet(f"{many_cells}/orders.parquet").count()
    assert size < 435 * cells * 8 / 20


def test_field_count_check_keeps_fields_in_parts(spark, many_cells):
    """rows of a store of tables hold parts of fields, and a field counts once however many parts it has."""
    before = _stores(spark, "store-*")
    assert QUERIES["field_count_check"](spark, many_cells).count() == 17
    store, _ = _stored(spark, "store-*", before)
    rows = spark.read.parquet(store).where("param_id = 500014").groupBy("step", "lev").agg(F.count("*").alias("n"))
    assert rows.agg(F.min("n")).first()[0] > 1


def _parts(spark, values, size, lev=3, param="T"):
    from rimecast.functions import constants as C

    rows = [(1, lev, "ml", "none", values[k : k + size], "CH1", "20240101", "0000", "001", C.PARAMS[param], k) for k in range(0, len(values), size)]
    return spark.createDataFrame(rows, "step int, lev int, levtype string, timespan string, values array<double>, model string, run_date string, run_time string, member string, param_id int, at int")


def test_messages_put_together_from_parts_are_those_of_whole_fields(spark, tmp_path):
    import numpy as np

    from rimecast.functions import constants as C
    from rimecast.sources import field_source as fs
    from rimecast.sources import messages as m

    rng = np.random.default_rng(5)
    fields = {1: rng.normal(280, 9, 1000), 2: np.where(rng.random(1000) < 0.3, np.nan, 7.25), 3: np.full(1000, np.nan)}
    parts = [_parts(spark, v.tolist(), 300 + 7 * k, k) for k, v in fields.items()]
    fs.write_field_parts(parts[0].unionByName(parts[1]).unionByName(parts[2]).repartition(5), str(tmp_path))
    when = {"run_date": "20240101", "run_time": "0000", "member": "001", "step": 1}
    want = b"".join(m.field_message("T", v, **when, lev=k) for k, v in fields.items())
    path = tmp_path / f"CH1/20240101/0000/001/{C.PARAMS['T']}/00001.fields"
    with fs.pafs.LocalFileSystem().open_input_file(str(path)) as f:
        frames = fs.Frames(f, str(path))
        assert frames.read_at(frames.size(), 0) == want and frames.read_at(70, 3000) == want[3000:3070]
    got = {r["lev"]: r["values"] for r in fs.MessageStore(spark, str(tmp_path)).scan().collect()}
    assert got.keys() == fields.keys() and all(np.array_equal(got[k], v, equal_nan=True) for k, v in fields.items())
    # the same place in plain form takes the place of the frames
    fs.write_field_files(_parts(spark, [1.0, 2.0], 2, 1).drop("at"), str(tmp_path))
    assert [(r["lev"], r["values"]) for r in fs.MessageStore(spark, str(tmp_path)).scan().collect()] == [(1, [1.0, 2.0])]
    for wrong in (parts[0].where("at > 0"), parts[0].unionByName(parts[0]), parts[0].where("at <> 307")):
        with pytest.raises(Exception, match="a part begins at cell"):
            fs.write_field_parts(wrong, str(tmp_path / "wrong"))


def test_long_messages_are_read_part_by_part(spark):
    import numpy as np

    from rimecast.sources import messages as m

    rng = np.random.default_rng(6)
    for bits in (None, 0, 7, 16):
        for undefined in (0.0, 0.4):
            values = np.where(rng.random(500) < undefined, np.nan, rng.normal(280, 20, 500))
            whole = m.field_message("T", values, run_date="20240101", run_time="0000", member="000", step=2, lev=5, bits=bits)
            long = m.LongMessage(lambda n, at, whole=whole: whole[at : at + n], len(whole))
            got = list(long.values(64))
            assert [at for at, _ in got] == list(range(0, 500, 64)) and np.array_equal(np.concatenate([v for _, v in got]), m.values_of(whole), equal_nan=True)
            assert all(np.array_equal(v, m.values_of(whole)[at : at + 64], equal_nan=True) for at, v in long.values(64, 3, 5))
            codes = rng.integers(0, 14, 500)
            assert m.coded_message(long.head(), codes.astype(np.uint8)) == m.refill(whole, codes)


def test_message_roundtrip_takes_codes_in_parts(spark, tmp_path):
    """codes in parts give the messages of whole fields; parts that leave a gap, and steps without a template, are errors."""
    import numpy as np

    from rimecast.sources import messages as m
    from rimecast.sources.sinks import commit_codes, read_codes, read_messages

    codes = np.random.default_rng(7).integers(0, 14, 700).tolist()
    keys = ("CH1", "20240101", "0000", "001")
    rows = spark.createDataFrame([(*keys, s, k, codes[k : k + 64]) for s in (0, 1) for k in range(0, 700, 64)], "model string, run_date string, run_time string, member string, step int, at long, codes array<int>")
    own = [(*keys, s, bytearray(m.field_message("TOT_PREC", np.zeros(700), run_date="20240101", run_time="0000", member="001", step=s))) for s in (0, 1)]
    heads = spark.createDataFrame(own, "model string, run_date string, run_time string, member string, step int, message binary")
    commit_codes(rows.repartition(5), str(tmp_path), heads)
    for s, *_, message in [(r[4], r[5]) for r in own]:
        assert (tmp_path / f"CH1/20240101/0000/001/lfff000{s}0000.ptype.grib2").read_bytes() == m.refill(bytes(message), np.array(codes))
    assert {r["step"]: r["codes"] for r in read_messages(spark, str(tmp_path)).collect()} == {0: codes, 1: codes}
    parts = read_codes(spark, str(tmp_path), 128).collect()
    assert len(parts) == 12 and all(r["codes"] == codes[r["at"] : r["at"] + 128] for r in parts)
    with pytest.raises(Exception, match="begin at cell 192, expected 128"):
        commit_codes(rows.where("at <> 128"), str(tmp_path / "x"), heads)
    with pytest.raises(Exception, match="no template for"):
        commit_codes(rows, str(tmp_path / "x"), heads.where("step = 0"))


def test_run_outputs_exchanges_packed_groups(spark, tmp_path):
    """parts of a store go packed from their rows to the diagnostic, wherever they were cut, and requests give their values."""
    from rimecast.operators import blocks
    from rimecast.sources.field_store import FieldStore, packed, write_fields

    values = [float(k % 97) for k in range(blocks.GROUP + 5000)]
    parts = _parts(spark, values, 20_000, 2)
    rest = "step int, lev int, levtype string, timespan string, model string, run_date string, run_time string, member string, param_id int, at int"
    write_fields(parts.mapInArrow(lambda batches: map(packed, batches), f"{rest}, n int, data binary"), str(tmp_path))
    write_fields(_parts(spark, values, len(values), 3).drop("at"), str(tmp_path))
    store = FieldStore(spark, str(tmp_path))
    ask = {"model": "CH1", "run_date": "20240101", "run_time": "0000", "member": "001", "params": ["T"]}
    whole = {}
    for r in sorted(store.request(**ask).collect(), key=lambda r: r["at"]):
        whole[r["lev"]] = whole.get(r["lev"], []) + r["values"]
    assert whole == {2: values, 3: values} and store.keys(**ask).count() == 2
    groups = blocks.field_groups(store.stored(**ask))
    got = {(number, lev): v.tolist() for number, _, rows in blocks._steps(groups.orderBy("group", "step", "param_id", "lev", "begin").toArrow().to_batches()) for lev, v in blocks._copies(rows[500014])}
    assert got == {(k, lev): values[k * blocks.GROUP : (k + 1) * blocks.GROUP] for k in (0, 1) for lev in (2, 3)}
    plan = blocks.diagnose_groups(groups, first_level=2, last_level=3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(group" in plan and not re.search(r"Exchange .*values#", plan)


def test_parts_that_do_not_follow_each_other_are_no_field():
    import numpy as np

    from rimecast.operators.blocks import _copies

    a, b = np.arange(4.0), np.arange(3.0)
    assert [(lev, v.tolist()) for lev, v in _copies([(1, 4, b), (1, 0, a), (2, 0, b)])] == [(1, [*a, *b]), (2, [*b])]
    assert [len(v) for _, v in _copies([(1, 0, a), (1, 0, b), (1, 3, a)])] == [4, 7]
    for wrong in ([(1, 2, a)], [(1, 0, a), (1, 5, b)], [(1, 0, a), (1, 3, b)]):
        with pytest.raises(LookupError, match="don't follow each other"):
            _copies(wrong)


def test_run_summary_deals_codes_out_before_they_become_rows(spark, tmp_path):
    """codes in blocks are written as the rows that they stand for, few files a step; a wrong code or number is an error."""
    from rimecast.sources.sinks import read_categorical, write_categorical

    keys = "model string, run_date string, run_time string, member string, step int"
    run = ("CH1", "20240101", "0000", "000")
    codes = spark.createDataFrame([(*run, s, k, [0, 1, 3, 13][: 4 if k < 36 else 2]) for s in range(3) for k in range(0, 40, 4)], f"{keys}, at long, codes array<int>").repartition(6)
    assert write_categorical(codes, str(tmp_path), expected=3 * 38) == {"000": 3}
    got = sorted(tuple(r) for r in read_categorical(spark, str(tmp_path)).select("step", "cell_id", "ptype").collect())
    assert got == [(s, c, [0, 1, 3, 13][c % 4]) for s in range(3) for c in range(38)]
    assert len(list(tmp_path.rglob("*.parquet"))) == 3
    for wrong, said in ((codes.where("at > 0"), "expected 114"), (codes.withColumn("codes", F.transform("codes", lambda c: c + 1)), "unknown code")):
        with pytest.raises(ValueError, match=said):
            write_categorical(wrong, str(tmp_path), expected=114)
    assert sorted(tuple(r) for r in read_categorical(spark, str(tmp_path)).select("step", "cell_id", "ptype").collect()) == got
