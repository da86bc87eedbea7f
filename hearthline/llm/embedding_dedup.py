"""Near duplicates among embeddings by sorted projection passes.

In each pass every vector gets a key of concatenated random hashes, the signs
of random projections, and vectors are sorted by it. Near vectors mostly share
the first bits, so they stand close together; each vector is compared with a
bounded window of neighbours. Verified pairs of all passes are united.

Equal vectors are one node. In a window only a spanning forest of the verified
pairs is passed on, so a dense cluster does not multiply. Links are then
counted inside each component by comparing it block with block, all of it, so
that no window cuts the count.

Where the vectors of a label lean one way, strangers share the first bits too
and fill the windows. So after the first passes about QUERIES vectors of each
label are compared with all of it. A label where less than TARGET of their
links lie inside components gets as many passes again, and so on, until that
share is reached or comparing the label whole costs no more than its passes
did; then it is compared whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import batches, components, cut

PASSES, BITS, WINDOW = 16, 48, 32
#: Nodes of a component in one block of the count.
BLOCK = 512
#: Vectors of a label that recall is measured on, and the share of their links to be found.
QUERIES, TARGET = 1024, 0.95
#: Rows of a label that its queries meet at once, and of a block where a label is compared whole.
CHUNK, WHOLE = 8192, 2048


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares stay in range."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dimension)


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.array([len(v) for v in batch.column("vector")])
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


@functools.cache
def _projections(dimension: int, turn: int) -> np.ndarray:
    return np.random.default_rng([dimension, turn]).normal(size=(dimension, BITS))


def _key_batch(turns: range, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for size, part in _by_dimension(batch):
        unit = _unit(_matrix(part.column("vector"), size))
        for turn in turns:
            keys = (unit @ _projections(size, turn) > 0) @ weights
            n = len(keys)
            arrays = [pa.array(np.full(n, turn, np.int32)), part.column("label"), pa.array(np.full(n, size, np.int32)), pa.array(keys), part.column("node"), part.column("vector")]
            yield pa.RecordBatch.from_arrays(arrays, names=["turn", "label", "dimension", "key", "node", "vector"])


def _forest(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs that join parts not joined yet."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        one, other = find(x), find(y)
        if one != other:
            root[max(one, other)] = min(one, other)
            yield x, y


def _window_stream(threshold: float, window: int, stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before: pa.Table | None = None
    for batch in stream:
        for low in range(0, batch.num_rows, 2048):
            now = pa.Table.from_batches([batch.slice(low, 2048)])
            fresh = now.num_rows
            now = now if before is None else pa.concat_tables([before, now])
            before = now.slice(max(0, now.num_rows - window))
            found_a, found_b = [], []
            groups = list(zip(*(now.column(c).to_pylist() for c in ("turn", "label", "dimension")), strict=True))
            cuts = [0, *(k for k in range(1, len(groups)) if groups[k] != groups[k - 1]), len(groups)]
            nodes = now.column("node").to_numpy()
            old = now.num_rows - fresh
            for first, last in zip(cuts, cuts[1:], strict=False):
                if last - first < 2 or last <= old:
                    continue
                unit = _unit(_matrix(now.column("vector").slice(first, last - first).combine_chunks(), groups[first][2]))
                for step in range(1, min(window, last - first - 1) + 1):
                    near = np.flatnonzero(np.einsum("ij,ij->i", unit[step:], unit[:-step]) >= threshold)
                    found_a.append(nodes[first + near])
                    found_b.append(nodes[first + near + step])
            if found_a:
                pairs = list(_forest(np.concatenate(found_a), np.concatenate(found_b)))
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], names=["a", "b"])


def _usable(vector: Column, label: Column) -> Column:
    values = vector.cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(values, lambda x: x != 0), F.lit(False))


def _block_counts(threshold: float, rows: pd.DataFrame) -> pd.DataFrame:
    """How many vectors of the other block (or of the same one) each node links with."""
    unit = _unit(np.stack(rows["vector"].to_numpy()).astype(float))
    near = unit @ unit.T >= threshold
    block = rows["block"].to_numpy()
    crossing = rows["low"].iloc[0] != rows["high"].iloc[0]
    if crossing:
        near &= block[:, None] != block[None, :]
    else:
        np.fill_diagonal(near, False)
    return pd.DataFrame({"node": rows["node"], "linked": near @ rows["copies"].to_numpy()})


def _query_recall(threshold: float, rows: pd.DataFrame) -> pd.DataFrame:
    """Links of the queries with the rows of a chunk, and how many lie inside a component."""
    asked = rows["asked"].to_numpy()
    unit = _unit(np.stack(rows["vector"].to_numpy()).astype(float))
    node, component = rows["node"].to_numpy(), rows["component"].to_numpy()
    linked = found = 0
    others = np.flatnonzero(~asked)
    for part in np.array_split(np.flatnonzero(asked), -(-int(asked.sum()) // 256) or 1):
        near = (unit[part] @ unit[others].T >= threshold) & (node[part][:, None] != node[others])
        linked += int(near.sum())
        found += int((near & (component[part][:, None] == component[others])).sum())
    return pd.DataFrame({"label": rows["label"].iloc[:1], "dimension": rows["dimension"].iloc[:1], "linked": [linked], "found": [found]})


def _block_parts(threshold: float, rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs that join what links connect inside two blocks."""
    unit = _unit(np.stack(rows["vector"].to_numpy()).astype(float))
    near = unit @ unit.T >= threshold
    nodes, left, pairs = rows["node"].to_numpy(), np.ones(len(rows), bool), []
    for k in np.flatnonzero(near.sum(axis=1) > 1):
        fresh = np.array([k]) if left[k] else np.zeros(0, int)
        while len(fresh):
            left[fresh] = False
            pairs += [(nodes[k], nodes[other]) for other in fresh if other != k]
            fresh = np.flatnonzero(near[fresh].any(axis=0) & left)
    return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _meetings(members: DataFrame, group: list[str], size: int, *carried: str) -> DataFrame:
    """The rows of every two blocks of a group of ``nodes``, under the blocks' numbers ``low`` and ``high``."""
    members = members.withColumn("blocks", F.ceil(F.col("nodes") / size).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    meeting = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return meeting.select(*group, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", *carried, "vector")


def _behind(part: DataFrame, joined: DataFrame, threshold: float) -> DataFrame:
    """(label, dimension) of the labels whose queries have too many links between components."""
    rows = part.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = rows.withColumn("chunks", F.ceil(F.col("nodes") / CHUNK).cast("int"))
    names = ["label", "dimension", "chunk", "asked", "node", "component", "vector"]
    own = rows.withColumns({"chunk": F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"), "asked": F.lit(False)}).select(*names)
    asked = rows.where(F.pmod("two", F.ceil(F.col("nodes") / QUERIES)) == 0).withColumn("asked", F.lit(True))
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*names)

    def measured(rows: pd.DataFrame) -> pd.DataFrame:
        return _query_recall(threshold, rows)

    kind = part.schema["label"].dataType.simpleString()
    links = own.union(asked).groupBy("label", "dimension", "chunk").applyInPandas(measured, f"label {kind}, dimension int, linked long, found long")
    links = links.groupBy("label", "dimension").agg(F.sum("linked").alias("linked"), F.sum("found").alias("found"))
    return links.where(F.col("found") < F.col("linked") * TARGET).select("label", "dimension")


def _joined(classes: DataFrame, threshold: float, window: int) -> DataFrame:
    """(node, component) of the nodes that links join, by passes until recall is reached."""
    group = ["label", "dimension"]
    kind, label = classes.schema["vector"].dataType.simpleString(), classes.schema["label"].dataType.simpleString()
    schema = f"turn int, label {label}, dimension int, key long, node long, vector {kind}"
    order = ["turn", "label", "dimension", "key", "node"]
    part = classes.select("label", F.size("vector").alias("dimension"), "two", "node", "vector")
    part = part.join(part.groupBy(*group).agg(F.count("*").alias("nodes")), group)

    def parts(rows: pd.DataFrame) -> pd.DataFrame:
        return _block_parts(threshold, rows)

    joined, turns = None, range(PASSES)
    while True:
        keyed = part.select("label", "node", "vector").mapInArrow(batches(functools.partial(_key_batch, turns)), schema)
        placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        pairs = placed.mapInArrow(functools.partial(_window_stream, threshold, window), "a long, b long")
        if joined is not None:
            pairs = pairs.union(joined.select("node", "component"))
        joined = cut(components(pairs, "joined"), "joined")
        behind = cut(_behind(part, joined, threshold), "behind")
        if behind.isEmpty():
            return joined
        part = cut(part.join(behind, group), "behind")
        # A pass costs a node ``window`` comparisons, all pairs half its label's nodes.
        cheap = F.col("nodes") <= 2 * window * turns.stop
        whole = part.where(cheap)
        if not whole.isEmpty():
            pairs = _meetings(whole, group, WHOLE).groupBy(*group, "low", "high").applyInPandas(parts, "a long, b long")
            joined = cut(components(pairs.union(joined.select("node", "component")), "joined"), "joined")
        part = part.where(~cheap)
        if part.isEmpty():
            return joined
        turns = range(turns.stop, 2 * turns.stop)


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98, window: int = WINDOW) -> DataFrame:
    """(id, n_links, component_id, kept), a row a vector.

    Only vectors of one label and dimension are compared. Those without a
    label, or that are null, empty, zero, or hold null or non-finite numbers,
    link with nothing and are their own component. Equal rows link. Repeated
    ids are rows of their own; a component's id is its smallest, null last.

    Pairs are found if they stand within ``window`` of each other in one of
    the passes' orders, or both belong to a component found so. There are
    PASSES of them, and in a label more until TARGET of the links of about
    QUERIES of its vectors are found, or until it is compared whole.
    """
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = rows.withColumn("usable", _usable(F.col("vector"), F.col("label")))
    rows = cut(rows.withColumns({"one": F.xxhash64("vector"), "two": F.xxhash64(F.lit(1), "vector")}), "vectors")
    name = ["label", "one", "two"]
    classes = rows.where("usable").groupBy(*name).agg(F.count("*").alias("copies"), F.min("id").alias("least_id"), F.first("vector").alias("vector"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    joined = _joined(classes, threshold, window)

    members = classes.join(joined, "node")
    sizes = joined.groupBy("component").agg(F.count("*").alias("nodes"))
    members = members.join(sizes, "component")
    meeting = _meetings(members, ["component"], BLOCK, "copies")

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        return _block_counts(threshold, rows)

    counts = meeting.groupBy("component", "low", "high").applyInPandas(counted, "node long, linked long")
    counts = counts.groupBy("node").agg(F.sum("linked").alias("linked"))
    least = members.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = classes.join(joined, "node", "left").join(counts, "node", "left").join(least, "component", "left")
    known = known.select(
        *name, (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id"), F.lit(True).alias("usable")
    )
    out = rows.join(known, [*name, "usable"], "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def vector_components(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors).withColumnRenamed("id", "vec_id")
