"""Exact top-k search by inner product in M-trees.

Vectors are cut into shards around pivots, and every shard gets an M-tree of
its own: pages of entries, each with a routing vector, a covering radius and
the distance to the routing vector of its page. The queries that visit a shard
walk its tree together, best first, each with its own upper bound of the
products that an entry can hold, and leave a page as soon as theirs is too low:

* q.x <= q.v + |q| r, as no vector of the entry is further than r from v;
* 2 q.x = |q|^2 + |x|^2 - d(q, x)^2, with the largest |x|^2 of the entry and
  d(q, x) >= d(q, v) - r.

Before an entry's own product is computed, both bounds are taken with the
stored distance to the parent in place of it; entries that cannot reach the
k-th score of any query are passed over without touching their vectors. A page
meets its queries in one matrix product.

A query first visits the shards with the highest bounds. Its k-th score there
is the floor for all others: only shards whose bound reaches it are visited.
Bounds of shards are compared with queries in blocks. Equal vectors are one
entry with the k + 1 smallest ids, so copies cost nothing and ties are kept.
"""

from __future__ import annotations

import heapq
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import batches, cut, free_name

SCALE = 256
#: Vectors of a shard, entries of a leaf page and of an inner page.
SHARD, LEAF, FANOUT = 8192, 128, 16
#: Pivots of all shards, at most; taken by the smallest hashes of a vector.
PIVOTS = 1024
#: Shards that a query visits first.
FIRST = 2
#: Queries and shards that are compared in one block, and queries of one walk.
BLOCK, WALK = 1024, 1024
#: Squared lengths up to here leave every product exact in a double.
LARGEST = float(1 << 52)

_SHARD = ["dimension", "pivot", "chunk"]
_SHARD_SCHEMA = "dimension int, pivot int, chunk int"


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dimension)


def whole_vectors(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, dimension, vector): components as floor(SCALE * x); rows that take no part are left out."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id).alias("id"), F.when(finite & (F.size(values) > 0), values).alias("values"))
    scaled = F.transform("values", lambda x: F.floor(x * SCALE).cast("int"))
    square = F.aggregate("values", F.lit(0.0), lambda sum, x: sum + (F.abs(x) * SCALE + 1) * (F.abs(x) * SCALE + 1))
    able = F.col("id").isNotNull() & F.col("values").isNotNull() & (square < LARGEST)
    return rows.where(able).select("id", F.size("values").alias("dimension"), scaled.alias("vector"))


def _members(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids and how often each occurs."""
    copies = rows.groupBy("dimension", "vector", "id").agg(F.count("*").alias("copies"))
    # The limit of a rank is applied in every task before the shuffle.
    rank = F.row_number().over(Window.partitionBy("dimension", "vector").orderBy("id"))
    least = copies.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    copies = F.least("copies", F.lit(k)).cast("int")
    listed = F.sort_array(F.collect_list(F.struct("id", copies.alias("copies"))))
    return least.groupBy("dimension", "vector").agg(listed.alias("members"))


def _sharded(members: DataFrame) -> DataFrame:
    """Adds the shard: the nearest pivot, and a part by hash where that holds too many."""
    counted = members.groupBy("dimension").count()
    wanted = F.least(F.ceil(F.col("count") / SHARD), F.lit(PIVOTS))
    rank = F.row_number().over(Window.partitionBy("dimension").orderBy(F.xxhash64("vector"), "vector"))
    first = members.select("dimension", "vector", rank.alias("rank")).where(F.col("rank") <= PIVOTS)
    chosen = first.join(counted.select("dimension", wanted.alias("wanted")), "dimension").where(F.col("rank") <= F.col("wanted"))
    pivots: dict[int, list[list[int]]] = {}
    for row in chosen.orderBy("rank", "dimension").limit(4 * PIVOTS).collect():
        pivots.setdefault(row["dimension"], []).append(row["vector"])
    centres = {d: np.array(v, float) for d, v in pivots.items()}

    def assign(batch: pa.RecordBatch):
        sizes = batch.column("dimension").to_numpy()
        for d in np.unique(sizes).tolist():
            part = batch.filter(pa.array(sizes == d))
            near = np.zeros(part.num_rows, np.int32)
            if d in centres:
                rows, to = _matrix(part.column("vector"), d), centres[d]
                near = np.argmin((to * to).sum(1) - 2 * rows @ to.T, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near)], names=[*part.schema.names, "pivot"])

    kind = members.schema["members"].dataType.simpleString()
    near = members.select("dimension", "vector", "members").mapInArrow(
        batches(assign), f"dimension int, vector array<int>, members {kind}, pivot int"
    )
    near = cut(near, "near-pivots")
    chunks = near.groupBy("dimension", "pivot").agg(F.ceil(F.count("*") / SHARD).alias("chunks"))
    chunk = F.pmod(F.xxhash64("vector"), F.col("chunks")).cast("int")
    return near.join(chunks, ["dimension", "pivot"]).withColumn("chunk", chunk).drop("chunks")


# --- trees ------------------------------------------------------------------

_PAGE = f"{_SHARD_SCHEMA}, page int, leaf boolean, vectors binary, parent binary, radius binary, norm binary, child binary, ids binary, copies binary"


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(axis=-1))


class _Tree:
    """The pages of one shard. Page -1 has one entry: the root, with page 0 below it."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.norms = vectors, (vectors**2).sum(axis=1)
        #: Page number, and places of the entries, distances to the page's routing vector, radii, norms, pages below.
        self.pages: list[tuple] = []
        entry = self._entry(np.arange(len(vectors)))
        self.pages.append((-1, False, [entry[0]], np.zeros(1), [entry[1]], [entry[2]], [entry[3]]))

    def _entry(self, rows: np.ndarray) -> tuple[int, float, float, int]:
        """Routing vector, covering radius, largest norm and page of some vectors."""
        part = self.vectors[rows]
        routing = int(rows[np.argmin(_distance(part, part.mean(axis=0)))])
        away = _distance(part, self.vectors[routing])
        number = len(self.pages)
        # The place is kept while the pages below are made.
        self.pages.append(())
        if len(rows) <= LEAF:
            zeros = np.zeros(len(rows))
            self.pages[number] = (number, True, rows, away, zeros, self.norms[rows], np.full(len(rows), -1))
        else:
            below = [self._entry(group) for group in self._groups(rows, away)]
            routes, radii, norms, pages = zip(*below, strict=True)
            away_of = _distance(self.vectors[list(routes)], self.vectors[routing])
            self.pages[number] = (number, False, list(routes), away_of, radii, norms, pages)
        return routing, float(away.max()), float(self.norms[rows].max()), number

    def _groups(self, rows: np.ndarray, away: np.ndarray) -> list[np.ndarray]:
        """Rows by the nearest of some that lie far from each other."""
        part, wanted = self.vectors[rows], min(FANOUT, -(-len(rows) // LEAF) + 1)
        nearest = np.full(len(rows), np.inf)
        owner = np.zeros(len(rows), np.int64)
        pick = int(np.argmax(away))
        for k in range(wanted):
            distance = _distance(part, part[pick])
            closer = distance < nearest
            owner[closer], nearest[closer] = k, distance[closer]
            pick = int(np.argmax(nearest))
        groups = [rows[owner == k] for k in range(wanted) if (owner == k).any()]
        if len(groups) > 1:
            return groups
        half = np.argsort(away, kind="stable")
        return [rows[half[: len(rows) // 2]], rows[half[len(rows) // 2 :]]]


def _build(k: int, table: pa.Table) -> pa.Table:
    shard = [table.column(c)[0].as_py() for c in _SHARD]
    vectors = _matrix(table.column("vector"), shard[0])
    ids = np.zeros((len(vectors), k + 1), np.int64)
    copies = np.zeros((len(vectors), k + 1), np.int32)
    for row, members in enumerate(table.column("members").to_pylist()):
        ids[row, : len(members)] = [m["id"] for m in members]
        copies[row, : len(members)] = [m["copies"] for m in members]
    rows = []
    for number, leaf, entries, parent, radius, norm, child in _Tree(vectors).pages:
        floats = [np.asarray(x, float).tobytes() for x in (parent, radius, norm)]
        held = (ids[entries].tobytes(), copies[entries].tobytes()) if leaf else (b"", b"")
        rows.append((*shard, number, leaf, vectors[entries].astype(np.int32).tobytes(), *floats, np.asarray(child, np.int32).tobytes(), *held))
    types = [pa.int32()] * 4 + [pa.bool_()] + [pa.binary()] * 7
    names = [*_SHARD, "page", "leaf", "vectors", "parent", "radius", "norm", "child", "ids", "copies"]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def trees(rows: DataFrame, k: int) -> DataFrame:
    """All pages of the M-trees over (id, dimension, vector) rows; a shard holds about SHARD vectors."""
    sharded = _sharded(cut(_members(rows, k), "distinct-vectors"))
    return cut(sharded.groupBy(*_SHARD).applyInArrow(lambda table: _build(k, table), _PAGE), "pages")


# --- search -----------------------------------------------------------------


def _bounds(products, distances, radius, norm, length, square):
    """The highest product that entries can hold, a little more than exact."""
    first = products + length * radius
    second = (square + norm - np.maximum(distances - radius, 0) ** 2) / 2
    return np.minimum(first, second) + 0.5 + 1e-9 * (square + norm)


class _Page:
    def __init__(self, row: dict, dimension: int, k: int):
        self.leaf = row["leaf"]
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(-1, dimension).astype(float)
        self.parent, self.radius, self.norm = (np.frombuffer(row[c]) for c in ("parent", "radius", "norm"))
        self.child = np.frombuffer(row["child"], np.int32).tolist()
        self.ids = np.frombuffer(row["ids"], np.int64).reshape(-1, k + 1)
        self.copies = np.frombuffer(row["copies"], np.int32).reshape(-1, k + 1)
        self.squares = (self.vectors**2).sum(axis=1)


def _walk_all(pages: dict[int, _Page], queries: np.ndarray, own: list[int], k: int, floors: np.ndarray) -> list[list[tuple[float, int]]]:
    """For each query the k best (-score, id) of a tree that reach its floor."""
    square = (queries**2).sum(axis=1)
    length, floors = np.sqrt(square), floors.astype(float)
    best: list[list[tuple[float, int]]] = [[] for _ in queries]
    start = np.arange(len(queries))
    order = itertools.count()
    # The page with the highest bound of all its queries, by their length, comes first.
    open_ = [(-math.inf, next(order), -1, start, np.full(len(start), math.inf), np.zeros(len(start)), np.zeros(len(start)))]
    while open_:
        _, _, number, who, bound, product, distance = heapq.heappop(open_)
        on = bound >= floors[who]
        if not on.any():
            continue
        who, product, distance, page = who[on], product[on, None], distance[on, None], pages[number]
        entries = np.arange(len(page.parent))
        if number >= 0 and (floors[who] > -math.inf).any():
            # From the parent alone: d(q, v) is at least the difference of both distances to it.
            far = np.abs(distance - page.parent)
            long, wide = length[who, None], square[who, None]
            by_parent = np.minimum(
                _bounds(product + long * page.parent, 0.0, page.radius, page.norm + wide, long, wide),
                _bounds(math.inf, far, page.radius, page.norm, long, wide),
            )
            able = by_parent >= floors[who, None]
            who, entries = who[able.any(axis=1)], np.flatnonzero(able.any(axis=0))
            if not len(who):
                continue
        products = queries[who] @ page.vectors[entries].T
        if page.leaf:
            reach = np.flatnonzero((products >= floors[who, None]).any(axis=1))
            for q, scores in zip(who[reach].tolist(), products[reach], strict=True):
                good = np.flatnonzero(scores >= floors[q])
                if len(good) > k + 1:
                    good = good[scores[good] >= np.partition(scores[good], -(k + 1))[-(k + 1)]]
                for at in good.tolist():
                    for member, copies in zip(page.ids[entries[at]].tolist(), page.copies[entries[at]].tolist(), strict=True):
                        if copies and member != own[q]:
                            best[q] += [(-float(scores[at]), member)] * copies
                best[q] = heapq.nsmallest(k, best[q])
                if len(best[q]) == k:
                    floors[q] = max(floors[q], -best[q][-1][0])
            continue
        long, wide = length[who, None], square[who, None]
        distances = np.sqrt(np.maximum(wide + page.squares[entries] - 2 * products, 0))
        bounds = _bounds(products, distances, page.radius[entries], page.norm[entries], long, wide)
        height = bounds / np.maximum(long, 1)
        wanted = bounds >= floors[who, None]
        for at in np.flatnonzero(wanted.any(axis=0)).tolist():
            some = wanted[:, at]
            held = (who[some], bounds[some, at], products[some, at], distances[some, at])
            heapq.heappush(open_, (-float(height[some, at].max()), next(order), page.child[entries[at]], *held))
    return best


def _walk(pages: dict[int, _Page], query: np.ndarray, own: int, k: int, floor: float) -> list[tuple[float, int]]:
    """The same for one query."""
    return _walk_all(pages, query[None], [own], k, np.array([floor]))[0]


_FOUND = "query_id long, query_key long, vec_id long, score long"


def _walks(k: int, queries: pa.Table, pages: pa.Table) -> pa.Table:
    found = []
    if queries.num_rows and pages.num_rows:
        dimension = queries.column("dimension")[0].as_py()
        held = {row["page"]: _Page(row, dimension, k) for row in pages.to_pylist()}
        vectors = _matrix(queries.column("vector"), dimension)
        ids, keys, floors = (queries.column(c).to_pylist() for c in ("query_id", "query_key", "floor"))
        floors = np.array([-math.inf if floor is None else floor for floor in floors], float)
        walked = zip(ids, keys, _walk_all(held, vectors, ids, k, floors), strict=True)
        found = [(query_id, key, id, int(-score)) for query_id, key, best in walked for score, id in best]
    columns = list(zip(*found, strict=True)) or [()] * 4
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_key", "vec_id", "score"])


def _search(pairs: DataFrame, pages: DataFrame, k: int) -> DataFrame:
    """Walks of (query, shard) pairs; queries of one shard are split into parts."""
    parts = pairs.groupBy(*_SHARD).agg(F.ceil(F.count("*") / WALK).alias("parts"))
    part = F.pmod(F.xxhash64("query_id", "query_key"), F.col("parts")).cast("int").alias("part")
    asked = pairs.join(parts, _SHARD).select(*pairs.columns, part)
    to = F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part")
    sent = pages.join(parts, _SHARD).select(*pages.columns, to)
    keys = [*_SHARD, "part"]
    return asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(lambda q, p: _walks(k, q, p), _FOUND)


_PAIR = f"query_id long, query_key long, {_SHARD_SCHEMA}, bound double"


def _shard_bounds(most: int | None, queries: pa.Table, roots: pa.Table) -> pa.Table:
    """Pairs of a query and a shard whose bound reaches the query's floor, or the highest few."""
    out = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.int32)] * 3 + [np.zeros(0)]
    if queries.num_rows and roots.num_rows:
        dimension = queries.column("dimension")[0].as_py()
        asked = _matrix(queries.column("vector"), dimension)
        entries = roots.to_pylist()
        centre = np.array([np.frombuffer(r["vectors"], np.int32) for r in entries], float)
        radius, norm = (np.array([np.frombuffer(r[c])[0] for r in entries]) for c in ("radius", "norm"))
        products = asked @ centre.T
        square = (asked**2).sum(axis=1)[:, None]
        distances = np.sqrt(np.maximum(square + (centre**2).sum(axis=1) - 2 * products, 0))
        bounds = _bounds(products, distances, radius, norm, np.sqrt(square), square)
        floor = np.array([-math.inf if f is None else f for f in queries.column("floor").to_pylist()])[:, None]
        wanted = bounds >= floor
        if most is not None and len(entries) > most:
            top = np.argsort(-bounds, axis=1, kind="stable")[:, :most]
            wanted = np.zeros_like(wanted)
            np.put_along_axis(wanted, top, True, axis=1)
        q, r = np.nonzero(wanted)
        shards = [np.array([e[c] for e in entries], np.int32)[r] for c in _SHARD]
        out = [*(queries.column(c).to_numpy()[q] for c in ("query_id", "query_key")), *shards, bounds[q, r]]
    return pa.Table.from_arrays([pa.array(x) for x in out], names=["query_id", "query_key", *_SHARD, "bound"])


def _routed(queries: DataFrame, roots: DataFrame, counts: tuple[int, int], most: int | None) -> DataFrame:
    """(query, shard) pairs to visit: every query meets the roots of all shards, block by block."""
    lots, blocks = (max(1, math.ceil(n / BLOCK)) for n in counts)
    lot = F.pmod(F.xxhash64("query_id", "query_key"), F.lit(lots)).cast("int")
    block = F.pmod(F.xxhash64("pivot", "chunk"), F.lit(blocks)).cast("int")
    every = {n: F.explode(F.sequence(F.lit(0), F.lit(m - 1))) for n, m in (("lot", lots), ("block", blocks))}
    asked = queries.withColumn("lot", lot).withColumn("block", every["block"])
    met = roots.withColumn("block", block).withColumn("lot", every["lot"])
    keys = ["dimension", "lot", "block"]
    return asked.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(lambda q, r: _shard_bounds(most, q, r), _PAIR)


def top_products(vectors: DataFrame, asked: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows with the highest integer inner product for each asked row.

    ``asked`` is a condition on the rows; each asked row is compared with all
    rows of another id, and ties go to the smaller id. Returns query_id, rank,
    vec_id, score, with fewer ranks where there are fewer rows. Rows without
    an id, null and empty vectors, vectors with null or non-finite components
    and vectors of SCALE * length beyond 2**26 (whose products are not exact)
    take no part; vectors of different dimension do not meet. A repeated row
    is a candidate each time and is asked once. Other columns are not read.
    """
    mark = free_name(vectors.columns, "asked")
    rows = cut(whole_vectors(vectors, id, vector), "whole-vectors")
    pages = trees(rows, k)
    wanted = whole_vectors(vectors.withColumn(mark, asked).where(F.col(mark)), id, vector).distinct()
    queries = cut(wanted.select(F.col("id").alias("query_id"), F.xxhash64("vector").alias("query_key"), "dimension", "vector"), "queries")
    roots = pages.where("page = -1").select(*_SHARD, "vectors", "radius", "norm")
    sizes = queries.count(), roots.count()
    key = ["query_id", "query_key"]
    best = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id"))

    # The shards with the highest bounds give each query a floor.
    unknown = queries.withColumn("floor", F.lit(None).cast("double"))
    high = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("bound"), *_SHARD))
    first = _routed(unknown, roots, sizes, FIRST).withColumn("high", high).where(F.col("high") <= FIRST)
    first = cut(first.select(*key, *_SHARD), "first-shards")
    found = cut(_search(first.join(unknown.drop("dimension"), key), pages, k), "first-walks")
    ranked = found.withColumn("rank", best)
    floors = ranked.where(F.col("rank") == k).select(*key, F.col("score").cast("double").alias("floor"))
    # All other shards that can still hold a score of that height.
    floored = cut(queries.join(floors, key, "left"), "floors")
    rest = _routed(floored, roots, sizes, None).select(*key, *_SHARD).join(first, [*key, *_SHARD], "left_anti")
    more = _search(cut(rest, "rest-shards").join(floored.drop("dimension"), key), pages, k)
    top = found.unionByName(more).withColumn("rank", best).where(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")


def highest_products(embeddings: DataFrame) -> DataFrame:
    """The query: the five highest scores of every row whose vec_id is divisible by 50."""
    return top_products(embeddings, F.col("vec_id") % 50 == 0)


SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 5"""
