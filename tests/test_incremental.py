"""What grows: the catalogue of bitmaps, and the stream of blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rimecast.functions import constants as C
from rimecast.operators import temporal
from rimecast.plans import bitmaps, catalog
from rimecast.streaming.blocks import deaccumulate_blocks, replay_blocks

KEYS = "model string, run_date string, run_time string, member string, param_id int, levtype string, timespan string, step int, lev int"


def _fields(spark, drop=()):
    rows = []
    for member in ("000", "001"):
        for p, levtype, span, steps, levels in [("HHL", "ml", "none", [0], range(1, 5))] + [(p, "ml", "none", range(3), range(1, 4)) for p in ("T", "P", "QV")] + [("TOT_PREC", "sfc", "fs", range(3), [0]), ("T_G", "sfc", "none", range(3), [0])]:
            rows += [("CH1", "20240101", "0000", member, C.PARAMS[p], levtype, span, s, k) for s in steps for k in levels if (member, p, s, k) not in drop and (member, p) not in drop]
    return spark.createDataFrame(rows, KEYS)


@pytest.mark.parametrize("drop", [(), [("000", "T", 2, k) for k in (1, 2, 3)], [("001", "TOT_PREC", 1, 0)], [("000", "HHL", 0, 4)], [("001", "QV")]])
def test_bitmaps_say_what_the_listing_says(spark, tmp_path, drop):
    fields, expected = _fields(spark, set(drop)), catalog.expectations(spark, 2, full=3, half=4)
    kept = bitmaps.BitmapCatalogue(spark, str(tmp_path / "catalogue"))
    for k in range(3):  # step after step, each told twice
        kept.add(fields.where(F.col("step") == k))
        kept.add(fields.where(F.col("step") == k))
    want = {tuple(r) for r in catalog.completeness(fields, expected).collect()}
    assert {tuple(r) for r in bitmaps.completeness(kept.table(), expected).collect()} == want and any(not r[-1] for r in want) == bool(drop)
    before = kept.rows().count()
    kept.compact()
    assert kept.rows().count() < before and [p.name for p in (tmp_path / "catalogue").iterdir()] == ["generation-00000001"]
    got = bitmaps.completeness(kept.table(), expected)
    assert {tuple(r) for r in got.collect()} == want
    runs = {r["member"]: r["complete"] for r in catalog.complete_runs(got).collect()}
    assert runs == {m: not any(d[0] == m for d in drop) for m in ("000", "001")}


def test_discovery_reads_the_bitmaps_only(spark, tmp_path):
    kept = bitmaps.BitmapCatalogue(spark, str(tmp_path / "catalogue"))
    with pytest.raises(FileNotFoundError, match="no catalogue"):
        kept.rows()
    kept.add(_fields(spark))
    read = bitmaps.completeness(kept.table(), catalog.expectations(spark, 2)).inputFiles()
    assert read and all("/catalogue/generation-00000000/part-" in x for x in read)
    with pytest.raises(Exception, match="numbers from 0 to 32767, not 40000"):
        kept.add(_fields(spark).withColumn("step", F.lit(40000)))


def _blocks(spark, lost=()):
    rng = np.random.default_rng(2)
    rows = []
    for member in ("a", "b"):
        for b in range(2):
            acc = np.cumsum(rng.integers(0, 9, (6, 3)), axis=0).astype(float)
            acc[2, 1] = np.nan
            rows += [(member, b, s, acc[s].tolist()) for s in range(6) if (member, b, s) not in lost]
    return spark.createDataFrame(rows, "member string, block int, step int, vals array<double>")


def _batch(df):
    cells = df.select("member", "block", "step", F.posexplode("vals").alias("pos", "tot_prec")).withColumn("tot_prec", F.nanvl("tot_prec", F.lit(None)))
    return {(r["member"], r["block"], r["step"], r["pos"]): r["total_precip_mm"] for r in temporal.deaccumulate(cells, ["member", "block", "pos"]).collect()}


def _cells(rows):
    return {(r["member"], r["block"], r["step"], k): None if v is None or np.isnan(v) else v for r in rows for k, v in enumerate(r["amounts"])}


def test_a_stream_of_blocks_is_the_batch(spark, tmp_path):
    """Steps in mixed order, each told twice, through a query that is ended and goes on from its checkpoint."""
    df = _blocks(spark)
    got = replay_blocks(df.unionByName(df), ["member", "block"], str(tmp_path), parts=3).collect()
    assert len(got) == df.count() and _cells(got) == _batch(df)


def test_missing_steps_are_waited_for_or_given_up(spark, tmp_path):
    df = _blocks(spark, lost={("a", 1, 3), ("b", 0, 0)})
    held = replay_blocks(df, ["member", "block"], str(tmp_path / "held"), parts=2, stops=0).collect()
    want = _batch(_blocks(spark))
    assert _cells(held) == {k: v for k, v in want.items() if not (k[:2] == ("a", 1) and k[2] > 2) and k[:2] != ("b", 0)}
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = deaccumulate_blocks(stream, ["member", "block"], patience_ms=200).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="500 milliseconds").start(str(tmp_path / "out"))
    try:
        for _ in range(120):
            q.awaitTermination(0.5)
            got = spark.read.schema("member string, block int, step int, amounts array<double>").parquet(str(tmp_path / "out")).collect() if (tmp_path / "out").exists() else []
            if len(got) == df.count():
                break
    finally:
        q.stop()
    lost = {k for k in want if k[:3] in {("a", 1, 3), ("b", 0, 0)}}
    unknown = {k for k in want if k[:3] in {("a", 1, 4), ("b", 0, 1)}}
    assert _cells(got) == {k: None if k in unknown else v for k, v in want.items() if k not in lost}
