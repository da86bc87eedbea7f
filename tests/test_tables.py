"""Views over the test tables."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from catalog.tables import Tables


def _orders(folder, n):
    day = dt.datetime(2024, 1, 2)
    columns = {
        "o_orderkey": pa.array(range(n), pa.int64()),
        "o_custkey": pa.array([k * 7 % 50 for k in range(n)], pa.int64()),
        "o_orderstatus": pa.array(["O"] * n),
        "o_totalprice": pa.array([k * 1.5 for k in range(n)]),
        "o_orderdate": pa.array([day] * n, pa.timestamp("us")),
        "o_orderpriority": pa.array([f"1-URGENT {k}" for k in range(n)]),
    }
    pq.write_table(pa.table(columns), f"{folder}/orders.parquet", row_group_size=n)


def test_pages_of_one_row_group_are_made_by_all_cores(spark, tmp_path):
    _orders(tmp_path, 8000)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        # More splits than cores, of which one holds the rows.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        tasks = Tables(spark, str(tmp_path)).listing_pages.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sum(t["count"] for t in tasks) == 8000
    assert len(tasks) >= 8 and max(t["count"] for t in tasks) <= 2000


def test_tasks_grow_with_the_pages(spark, tmp_path, monkeypatch):
    _orders(tmp_path, 8000)
    monkeypatch.setattr("catalog.tables._TASK_ROWS", 300)
    assert Tables(spark, str(tmp_path)).listing_pages.rdd.getNumPartitions() == 32
