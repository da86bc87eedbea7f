"""What several operators share: intermediate tables, bounded sums, ranks, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthline.session import fresh_dir


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The written table ends the lineage: a lost executor costs only the tasks it
    ran, and what is used twice is not computed twice.
    """
    path = fresh_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], wanted: str) -> str:
    """A column name that no existing column has, whatever its case."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def batches(run: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]):
    """A ``mapInArrow`` function from a function of one batch; skips empty batches."""

    def over(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                yield from run(batch)

    return over


# --- sums of bounded arrays -------------------------------------------------

#: Entries of one piece of a summed array.
SLICE = 8192


def _packed(part: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as they need, after a byte that says how many."""
    most = max(abs(int(part.min())), abs(int(part.max())))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return bytes([width]) + part.astype(f"<i{width}").tobytes()


def _unpacked(data: pa.Buffer | bytes) -> np.ndarray:
    data = memoryview(data)
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def array_rows(counts: np.ndarray) -> pa.RecordBatch:
    """One task's array as rows of pieces; pieces of zeros are left out."""
    parts = [(k, counts[k * SLICE : (k + 1) * SLICE]) for k in range(-(-len(counts) // SLICE))]
    parts = [(k, _packed(part)) for k, part in parts if part.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in parts], pa.int32()), pa.array([v for _, v in parts], pa.binary())],
        names=["slice", "data"],
    )


def _add_slices(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in stream:
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = _unpacked(data.as_buffer())
            sums[k] = sums[k] + values if k in sums else values
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([_packed(v) for v in sums.values()], pa.binary())],
            names=["slice", "data"],
        )


def sum_arrays(rows: DataFrame, length: int) -> np.ndarray:
    """The sum of all tasks' arrays of a fixed length.

    The pieces are added up where they meet, one batch at a time, so a task
    holds one array however many tasks there were. The result has the fixed
    length, so that it may come to the driver and be broadcast.
    """
    slices = -(-length // SLICE)
    # Two rounds: tasks first meet in groups, then all of them.
    spread = rows.repartition("slice", F.pmod(F.spark_partition_id(), F.lit(8)))
    once = spread.mapInArrow(_add_slices, "slice int, data binary").repartition("slice")
    total = np.zeros(slices * SLICE, np.int64)
    for row in once.mapInArrow(_add_slices, "slice int, data binary").collect():
        part = _unpacked(bytes(row["data"]))
        total[row["slice"] * SLICE : row["slice"] * SLICE + len(part)] += part
    return total[:length]


# --- prefix sums ------------------------------------------------------------


def sums_before(df: DataFrame, groups: list[str], key: str, order: list[str], weight: str, into: str) -> DataFrame:
    """Adds the sum of ``weight`` over the rows of the same group that come earlier.

    Rows of a group are ordered by ``key`` (hexadecimal digits of a hash), then
    by ``order``; group columns must not be null. The first digits cut every
    group into ranges of hashes. Each range is summed, the sums are added along
    the ranges in two steps of 256, and only rows of the same short range are
    added up one by one. So no task holds a group, however large it is.
    """
    names = [free_name(df.columns, n) for n in ("_first", "_second", "_sum", "_base", "_here")]
    first, second, total, base, here = names
    ranged = df.withColumns({first: F.substring(key, 1, 2), second: F.substring(key, 3, 2)})
    fine = ranged.groupBy(*groups, first, second).agg(F.sum(weight).alias(total))
    coarse = fine.groupBy(*groups, first).agg(F.sum(total).alias(total))
    along = Window.partitionBy(*groups).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select(*groups, first, F.coalesce(F.sum(total).over(along), F.lit(0)).alias(here))
    along = Window.partitionBy(*groups, first).orderBy(second).rowsBetween(Window.unboundedPreceding, -1)
    fine = fine.withColumn(base, F.coalesce(F.sum(total).over(along), F.lit(0))).join(coarse, [*groups, first])
    fine = fine.select(*groups, first, second, (F.col(base) + F.col(here)).alias(base))
    along = Window.partitionBy(*groups, first, second).orderBy(key, *order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn(into, F.coalesce(F.sum(weight).over(along), F.lit(0)))
    joined = inside.join(fine, [*groups, first, second])
    return joined.withColumn(into, (F.col(into) + F.col(base)).cast("long")).select(*df.columns, into)


# --- connected components ---------------------------------------------------


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
    return row[0], row[1]


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b), longs; the component
    is its smallest node.

    Large-star and small-star steps in turn: every node hands its neighbours to
    the smallest of them until only stars are left. A node with very many
    neighbours is only a skewed join key, which adaptive execution splits.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.union(least.select("a", F.col("m").alias("b"))).distinct(), label)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def text_column(df: DataFrame, name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
