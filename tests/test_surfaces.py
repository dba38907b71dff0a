"""The SQL surface and the throughput command."""

import pytest
from pyspark.sql import functions as F

from rimecast import throughput
from rimecast.functions.sql_tables import register_tables
from rimecast.operators.kernel import categorical_arrays
from rimecast.sources.synthetic import synthetic_arrays, synthetic_levels


def test_a_table_function_gives_the_codes(spark):
    register_tables(spark)
    levels = synthetic_levels(spark, 60, 20).withColumn("region", F.col("cell_id") % 2)
    # a column without a temperature, and one without precipitation
    levels = levels.withColumn("temperature_k", F.when(~((F.col("cell_id") == 4) & (F.col("lev") == 3)), F.col("temperature_k"))).withColumn("total_precip_mm", F.when(F.col("cell_id") != 5, F.col("total_precip_mm")))
    got = spark.sql("SELECT * FROM diagnose(TABLE({levels}) PARTITION BY cell_id ORDER BY lev)", levels=levels)
    assert sorted(got.columns) == ["cell_id", "ptype", "region"]
    rows = {r["cell_id"]: (r["region"], r["ptype"]) for r in got.collect()}
    want = {r["cell_id"]: r["ptype"] for r in categorical_arrays(synthetic_arrays(spark, 60, 20), ["cell_id"]).collect()}
    assert {c: p for c, (_, p) in rows.items() if c not in (4, 5)} == {c: p for c, p in want.items() if c not in (4, 5)}
    assert all(region == c % 2 for c, (region, _) in rows.items()) and rows[5][1] == 0
    high = spark.sql("SELECT cell_id, ptype FROM diagnose(TABLE({levels}) PARTITION BY cell_id ORDER BY lev, threshold => 1.0)", levels=levels)
    assert {r["cell_id"] for r in high.collect() if r["ptype"]} <= {c for c in rows if c < 30}
    assert spark.sql("SELECT * FROM diagnose(TABLE({levels}) PARTITION BY cell_id ORDER BY lev)", levels=levels.limit(0)).count() == 0
    with pytest.raises(Exception, match="lacks height_m"):
        spark.sql("SELECT * FROM diagnose(TABLE({levels}) PARTITION BY cell_id ORDER BY lev)", levels=levels.drop("height_m")).collect()


def test_throughput_lines(spark, capsys):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    t = throughput.measure(spark, n_columns=40, n_levels=10, repeat=2, chunk_size=16)
    assert (t.active_columns, t.total_columns, t.retained_full_levels) == (30, 40, 10) and t.diagnose_s > 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert [x.split("=")[0] for x in t.lines()] == "case backend diagnose_s active_columns total_columns retained_full_levels columns_per_second".split()
    assert throughput.Throughput(2.0, 30, 40, 10).lines()[2:] == ["diagnose_s=2.000", "active_columns=30", "total_columns=40", "retained_full_levels=10", "columns_per_second=15.0"]
    for bad in (["--repeat", "0"], ["--n-levels", "x"]):
        with pytest.raises(SystemExit):
            throughput.main(bad)
    with pytest.raises(ValueError, match="at least 1"):
        throughput.measure(spark, n_columns=0, n_levels=1, repeat=1, chunk_size=1)
