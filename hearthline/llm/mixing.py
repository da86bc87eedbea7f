"""Mixing sources to target weights.

Every document gets a hash-random key. Documents are ordered by key within
their source, sizes are added up along that order by distributed prefix sums,
and each source is cut where its budget of words is reached. A budget above the
source's size goes around again in whole epochs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import cut, free_name, sums_before, text_column

SEED = "mixture-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_no, source_size, target) from one row (source, source_size) a source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    all words by weight; a target stops at ``cap`` times its source's size, and
    what that leaves is shared again by weight until no target is above. That
    is the least of the cap and one level times the weight. With the sources
    ordered by cap over weight, the level if all before are capped is what
    remains over the weights that remain; the level sought is the one at the
    first source that it does not cap, which is the largest of those levels
    that lie below their own source's cap.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    cases = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    known = sizes.withColumn("source_no", (F.row_number().over(rank) - 1).cast("long")).withColumn("weight", cases)
    known = known.withColumn("most", F.col("source_size") * cap).withColumn("ratio", F.col("most").cast("double") / F.col("weight"))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    known = known.withColumn("level", left.cast("double") / weight_left)
    level = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(every)
    target = F.coalesce(F.least(F.col("most").cast("double"), level * F.col("weight")), F.col("most").cast("double"))
    return known.withColumn("target", target).select("source", "source_no", "source_size", "target")


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(id, text_hash, size, source_size, target, taken), a row a document.

    ``size`` counts words; null text has none. ``taken`` is the number of words
    the mix takes: whole epochs, and in the last one what lies before the cut,
    which falls inside at most one document a source. So a source's taken words
    are its target, rounded down. Order is by the md5 of seed and id, then size
    and text; a rerun takes the same. Documents with a null id are ordered by
    their text. A null source is a source of its own, after all others.
    """
    whole = text_column(docs, text)
    sized = docs.select(
        F.col(id).alias("id"),
        F.xxhash64(whole).alias("text_hash"),
        F.col(source).cast("string").alias("source"),
        word_count(whole).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.md5(whole)))).alias("key"),
    )
    # Narrow rows, written once: totals, ranges and rows are read from them.
    sized = cut(sized, "sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop("source")
    rows = sums_before(rows, ["source_no"], "key", ["size", "text_hash"], "size", "before")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    rest = F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(F.lit(0))
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return rows.select("id", "text_hash", "size", "source_size", "target", (epochs * F.col("size") + last).cast("long").alias("taken"))


def mixture(docs: DataFrame) -> DataFrame:
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def take(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for each epoch that takes the document.

    A document is repeated whole; the one that a cut falls into is kept whole
    as well, so a source goes over its target by less than one document.
    Documents that the mix does not take go. Rows that share an id and a text
    are taken alike.
    """
    chosen = mix(docs, **options)
    id, text = options.get("id", "doc_id"), options.get("text", "text")
    key, hashed, copies, other = (free_name(docs.columns, n) for n in ("_id", "_hash", "_copies", "_text_hash"))
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    # Repeated rows (same id, same text) are taken as often as the first of them.
    chosen = (
        chosen.where("taken > 0")
        .groupBy(F.col("id").alias(key), F.col("text_hash").alias(other))
        .agg(F.max(times).alias(copies))
    )
    marked = docs.withColumn(hashed, F.xxhash64(text_column(docs, text)))
    joined = marked.join(chosen, marked[id].eqNullSafe(chosen[key]) & (F.col(hashed) == F.col(other)))
    out = joined.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return out.select(*[joined[name] for name in docs.columns])


SQL = """
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
    md5('mixture-1:' || cast(doc_id as varchar)) as key
  from documents
), totals as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as source_no
  from sized group by source
), weighted as (
  select *, 1 + source_no % 3 as weight, source_size * 3 as most,
    cast(source_size * 3 as double) / (1 + source_no % 3) as ratio
  from totals
), levels as (
  select *, cast(sum(source_size) over () - coalesce(sum(most) over previous, 0) as double)
      / (sum(weight) over () - coalesce(sum(weight) over previous, 0)) as level
  from weighted
  window previous as (order by ratio, source_no rows between unbounded preceding and 1 preceding)
), targets as (
  select source, source_size, coalesce(least(cast(most as double),
      max(case when ratio > level then level end) over () * weight), cast(most as double)) as target
  from levels
), placed as (
  select doc_id, size, source_size, target, cast(floor(target) as bigint) as budget,
    cast(coalesce(sum(size) over (partition by t.source order by key, size, doc_id
      rows between unbounded preceding and 1 preceding), 0) as bigint) as before
  from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  cast(case when source_size = 0 then 0 else
    (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) end as bigint) as taken
from placed
"""
