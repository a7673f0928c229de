"""What the shared logs and their copies cost: one exchange, half the disk."""

import re
from glob import glob

import pyarrow.parquet as pq
import pytest

from cdcstrata.checks.bronze import Tables
from cdcstrata.session import tune
from cdcstrata.sources.scratch import TEXT, store


@pytest.fixture()
def folder(spark, tmp_path):
    rows = {
        "lineitem": spark.createDataFrame(
            [(1, 1, 10.9), (1, 1, 5.0), (1, 2, 7.0), (2, 2, 3.0), (3, 9, 1.0)], "l_orderkey bigint, l_suppkey bigint, l_extendedprice double"
        ),
        "supplier": spark.createDataFrame([(1, 4), (2, 3)], "s_suppkey bigint, s_nationkey bigint"),
        "nation": spark.createDataFrame([(3, "CANADA"), (4, "EGYPT")], "n_nationkey bigint, n_name string"),
    }
    for name, df in rows.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_line_items_are_laid_out_once(spark, folder):
    arrays = Tables(spark, folder).export_arrays
    plan = arrays._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"[^a-zA-Z]Exchange ", plan)) == 1, plan
    canada, egypt = ('{{"country":"{}","current_sum":{}}}'.format(*x) for x in (("CANADA", 7), ("EGYPT", 15)))
    assert {r["k"]: r["export_array"] for r in arrays.collect()} == {1: f"[{canada},{egypt}]", 2: f"[{canada.replace('7', '3')}]"}


def test_copies_are_compressed_well(spark):
    path = store(spark.range(10).selectExpr("id", "string(id) AS text"), "copy", **TEXT).removeprefix("file:")
    for file in glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        assert meta.num_row_groups == 0 or {meta.row_group(g).column(c).compression for g in range(meta.num_row_groups) for c in range(meta.num_columns)} == {"ZSTD"}
    assert spark.read.parquet(path).count() == 10


def test_scan_size_of_the_cluster_stays(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "16m")
        assert tune(spark).conf.get(key) == "16m"
        spark.conf.unset(key)
        assert tune(spark).conf.get(key) == "64m"
    finally:
        spark.conf.set(key, before)
