"""Lines that repeat across documents, dropped by bitmaps.

Lines become narrow rows of (hash, document, position). They are range
partitioned by hash with document and position as secondary sort, so that a
line held by very many documents is spread over several tasks. Each run of one
line in one document then streams to its first place, runs of one line are
combined before they are shuffled once more, and what comes back to a document
is a bitmap of the lines it keeps. Text is never shuffled to find lines. All of
it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import cut, free_name, text_column

WHITE = " \t\n\v\f\r"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, with A-Z as small letters."""
    return F.translate(F.btrim(line, F.lit(WHITE)), CAPITALS, SMALL)


def keep_bitmaps(docs: DataFrame, id: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """For every document that loses lines: (id, text_hash, keep).

    Lines whose key has at least ``min_chars`` characters and is found in at
    least ``min_docs`` documents are lost: everywhere, or with ``keep_first``
    everywhere but at the first place by document and position. Documents are
    told apart by id and text, so a repeated row is one document, and rows that
    share an id but not a text are two; a null id is an id of its own. A null
    text is one empty line.

    ``keep`` is a compressed bitmap: a map from the number of a run of 64 lines
    to 64 bits, bit k set if line k of the run stays; runs that stay whole are
    left out, as are documents that lose nothing.
    """
    whole = text_column(docs, text)
    lines = docs.select(F.col(id).alias("id"), F.xxhash64(whole).alias("text_hash"), F.posexplode(F.split(whole, "\n", -1)).alias("position", "line"))
    key = line_key(F.col("line"))
    lines = lines.where(F.length(key) >= min_chars).select("id", "text_hash", "position", F.xxhash64(key).alias("hash"))
    # Written once: the range partitioning below reads its input twice.
    lines = cut(lines, "lines")
    runs = lines.repartitionByRange("hash", "id", "text_hash").sortWithinPartitions("hash", "id", "text_hash", "position")
    runs = runs.groupBy("hash", "id", "text_hash").agg(F.min("position").alias("position"))
    repeated = (
        runs.groupBy("hash")
        .agg(F.count("*").alias("documents"), F.min(F.struct("id", "text_hash", "position")).alias("first"))
        .where(F.col("documents") >= min_docs)
    )
    # Written, so that the join below reads plain tables on both sides: adaptive
    # execution then splits a hash that very many lines have.
    repeated = cut(repeated, "repeated")
    lost = lines.join(repeated, "hash")
    if keep_first:
        lost = lost.where(~F.struct("id", "text_hash", "position").eqNullSafe(F.col("first")))
    words = (
        lost.groupBy("id", "text_hash", F.expr("position div 64").cast("int").alias("run"))
        .agg(F.bitwise_not(F.bit_or(F.expr("shiftleft(1L, cast(position % 64 as int))"))).alias("bits"))
    )
    return words.groupBy("id", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("run", "bits"))).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id: str = "doc_id", text: str = "text", kept: str = "kept", lines: str = "n_lines", dropped: str = "n_dropped") -> DataFrame:
    """All rows and columns of ``docs``, with the text of the lines they keep and the counts of lines."""
    mask, hashed, key = (free_name(docs.columns, n) for n in ("_keep", "_hash", "_id"))
    narrow = bitmaps.select(F.col("id").alias(key), F.col("text_hash").alias(hashed + "b"), F.col("keep").alias(mask))
    whole = text_column(docs, text)
    marked = docs.withColumn(hashed, F.xxhash64(whole))
    joined = marked.join(narrow, marked[id].eqNullSafe(narrow[key]) & (F.col(hashed) == F.col(hashed + "b")), "left")
    all_lines = F.split(whole, "\n", -1)
    stays = F.filter(
        all_lines,
        lambda _, k: F.coalesce(F.getbit(F.try_element_at(F.col(mask), F.floor(k / 64).cast("int")), k % 64) == 1, F.lit(True)),
    )
    n_dropped = F.aggregate(F.map_values(F.col(mask)), F.lit(0).cast("long"), lambda total, bits: total + F.lit(64) - F.bit_count(bits))
    return joined.withColumns(
        {
            lines: F.size(all_lines).cast("long"),
            dropped: F.coalesce(n_dropped, F.lit(0).cast("long")),
            kept: F.when(F.col(mask).isNull(), whole).otherwise(F.array_join(stays, "\n")),
        }
    ).drop(mask, hashed, hashed + "b", key)


def drop_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with kept text and counts; see :func:`keep_bitmaps` for the options."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id, text, **options), id, text)


def rewrite(docs: DataFrame, id: str = "doc_id", text: str = "text", chars: str = "n_chars", **options) -> DataFrame:
    """``docs`` in its own columns, with the text of the lines kept and its length.

    A text that loses nothing stays as it is, also if it is null."""
    names = [free_name(docs.columns, n) for n in ("_kept", "_lines", "_dropped")]
    kept, lines, dropped = names
    out = apply_bitmaps(docs, keep_bitmaps(docs, id, text, **options), id, text, kept, lines, dropped)
    changed = {text: F.when(F.col(dropped) > 0, F.col(kept)).otherwise(F.col(text))}
    if chars in docs.columns:
        changed[chars] = F.when(F.col(dropped) > 0, F.length(kept).cast(docs.schema[chars].dataType)).otherwise(F.col(chars))
    return out.withColumns(changed).select(*docs.columns)


def line_digest(docs: DataFrame) -> DataFrame:
    """The digest of every document's kept text."""
    out = drop_repeated_lines(docs.select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
with lines as (
  select doc_id, generate_subscripts(parts, 1) as position, unnest(parts) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
  select doc_id, position, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), common as (
  select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10
), kept as (
  select k.doc_id, k.position, k.line, c.key is not null as gone from keyed k left join common c on k.key = c.key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by position) filter (not gone), '')) as kept_sha256
from kept group by doc_id
"""
