"""Exact order statistics and interpolated quantiles without a global sort.

Spark's exact ``percentile`` merges all distinct values of a column in one
task, and a global sort would move every row. Here the column is only scanned,
whatever its size. The scan that takes count and range also builds a mergeable
sketch, which brackets each wanted rank; a second scan confirms the brackets by
exact counts, and in a third the few values inside them are grouped and ranked.
On very large tables a bracket that is still large is narrowed by further
sketches; one that a sketch does not tighten is halved by value instead, so the
ranking is always short.
Values that occur very often arrive at it as one row with a count.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from hearthline.operators.projection import frame_from_rows, quoted

# Size of the first sketch. It is off by about 2.3 / SKETCH ** 0.9 of all ranks;
# three times that is allowed for.
SKETCH = 4096
# Accuracy of further sketches: ranks are bracketed to about 1 / ACCURACY of the rows.
ACCURACY = 10_000
# A bracket with at most this many rows goes to the ranking step.
RANKED_ROWS = 200_000


def clean_number(name: str) -> Column:
    """The column as double with NaN as null, the way null counts treat it."""
    value = quoted(name).cast("double")
    return F.when(~F.isnan(value), value)


@dataclass
class _Bracket:
    column: str
    first: int  # wanted rank, counted from 0
    last: int  # the rank above it when interpolating, else the same
    low: float
    high: float
    below: int = 0  # rows under low
    upto: int = 0  # rows up to and including high
    settled: bool = False
    halve: bool = False  # the last sketch did not tighten it

    @property
    def rows(self) -> int:
        return self.upto - self.below

    def holds(self, below: int, upto: int) -> bool:
        return below <= self.first and self.last < upto


def _inside(bracket: _Bracket) -> Column:
    value = clean_number(bracket.column)
    return F.when(value.between(bracket.low, bracket.high), value)


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> None:
    """One scan proposes tighter brackets, a second counts and confirms them."""
    _halve(df, [b for b in brackets if not b.settled and b.halve])
    todo = [b for b in brackets if not b.settled and not b.halve]
    if not todo:
        return
    # Brackets over the same range of a column share one sketch.
    shared: dict[tuple, list[int]] = {}
    for i, b in enumerate(todo):
        shared.setdefault((b.column, b.low, b.high), []).append(i)
    sketches = []
    for members in shared.values():
        points = []
        for b in (todo[i] for i in members):
            # Twice the sketch's error on both sides of the wanted ranks.
            slack = 2.0 / ACCURACY + 1.0 / b.rows
            points.append(max((b.first - b.below) / b.rows - slack, 0.0))
            points.append(min((b.last - b.below) / b.rows + slack, 1.0))
        sketches.append(F.percentile_approx(_inside(todo[members[0]]), points, ACCURACY))
    answers = df.agg(*[sk.alias(f"p{i}") for i, sk in enumerate(sketches)]).first()
    ends = {}
    for members, values in zip(shared.values(), answers, strict=True):
        for position, i in enumerate(members):
            ends[i] = values[2 * position], values[2 * position + 1]

    _confirm(df, todo, [ends[i] for i in range(len(todo))])


def _confirm(df: DataFrame, todo: list[_Bracket], ends: Sequence[tuple[float, float]]) -> None:
    """Count what lies below and up to the proposed ends; take those that hold their ranks."""
    counted = []
    for i, b in enumerate(todo):
        value, (low, high) = clean_number(b.column), ends[i]
        counted += [F.count_if(value < low).alias(f"b{i}"), F.count_if(value <= high).alias(f"u{i}")]
    counts = df.agg(*counted).first()

    for i, b in enumerate(todo):
        low, high = ends[i]
        below, upto = counts[f"b{i}"], counts[f"u{i}"]
        rows_before = b.rows
        if b.holds(below, upto):
            b.low, b.high, b.below, b.upto = low, high, below, upto
        b.halve = b.rows >= rows_before
        b.settled = b.rows <= RANKED_ROWS or b.low == b.high


def _halve(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Each bracket becomes the half of its value range that holds its ranks."""
    if not brackets:
        return
    parts = []
    for i, b in enumerate(brackets):
        value, middle = _inside(b), b.low + (b.high - b.low) / 2
        parts += [
            F.count_if(value <= middle).alias(f"n{i}"),
            F.max(F.when(value <= middle, value)).alias(f"l{i}"),
            F.min(F.when(value > middle, value)).alias(f"h{i}"),
        ]
    row, astride = df.agg(*parts).first(), []
    for i, b in enumerate(brackets):
        upto, low, high = b.below + row[f"n{i}"], row[f"l{i}"], row[f"h{i}"]
        if b.last < upto:
            b.high, b.upto = low, upto
        elif b.first >= upto:
            b.low, b.below = high, upto
        else:
            # The two ranks lie on either side: no other value is between them.
            b.low, b.high, b.settled = low, high, True
            astride.append(b)
        b.settled = b.settled or b.rows <= RANKED_ROWS or b.low == b.high
    if astride:
        counts = [F.count_if(clean_number(b.column) < b.low).alias(f"b{i}") for i, b in enumerate(astride)]
        for b, below in zip(astride, df.agg(*counts).first(), strict=True):
            b.below = below


def _ranked(df: DataFrame, brackets: list[_Bracket]) -> DataFrame:
    """(wanted, lower, upper): the values at both ranks of every bracket."""
    columns = list(dict.fromkeys(b.column for b in brackets))
    entries = F.array(*[F.struct(F.lit(i).alias("place"), clean_number(c).alias("value")) for i, c in enumerate(columns)])
    value = F.col("value")

    def held(b: _Bracket) -> Column:
        return (F.col("place") == columns.index(b.column)) & value.between(b.low, b.high)

    # Values are counted once for all brackets of their column, then dealt to them.
    hit = functools.reduce(lambda a, b: a | b, map(held, brackets))
    values = df.select(F.inline(entries)).filter(hit).groupBy("place", "value").agg(F.count("*").alias("n"))
    dealt = F.array(*[F.when(held(b), F.lit(i)) for i, b in enumerate(brackets)])
    counts = values.select(F.explode(dealt).alias("wanted"), "value", "n").filter(F.col("wanted").isNotNull())
    upto = F.sum("n").over(
        Window.partitionBy("wanted").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    limits = F.array(*[F.struct(F.lit(b.first - b.below).alias("first"), F.lit(b.last - b.below).alias("last")) for b in brackets])
    limit = F.get(limits, F.col("wanted"))
    return (
        counts.withColumn("upto", upto)
        .groupBy("wanted")
        .agg(
            F.min(F.when(F.col("upto") > limit["first"], F.col("value"))).alias("lower"),
            F.min(F.when(F.col("upto") > limit["last"], F.col("value"))).alias("upper"),
        )
    )


@dataclass
class Facts:
    """Count and range of a column, and between which values a sketch sees each fraction."""

    count: int
    low: float | None
    high: float | None
    ends: dict[float, tuple[float, float]]


def _brackets(df: DataFrame, wanted: Sequence[tuple[str, int, int, float | None]], facts: dict[str, Facts]) -> list[_Bracket]:
    out, proposed = [], []
    for column, first, last, fraction in wanted:
        f = facts[column]
        bracket = _Bracket(column, first, last, f.low, f.high, 0, f.count, settled=f.count <= RANKED_ROWS // 100 or f.low == f.high)
        out.append(bracket)
        if not bracket.settled and fraction in f.ends:
            proposed.append((bracket, f.ends[fraction]))
    if proposed:
        _confirm(df, [b for b, _ in proposed], [ends for _, ends in proposed])
        for b, _ in proposed:
            b.halve = False
    while not all(b.settled for b in out):
        _narrow(df, out)
    return out


def column_facts(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], extra: Sequence[Column] = ()
) -> tuple[dict[str, Facts], Row]:
    """Facts of the columns, and the values of further aggregates, from one scan."""
    parts, out = [], []
    # The sketch's error, and the ranks around a fraction where that counts: in columns that are not ranked at once.
    room = 3 * 2.3 / SKETCH**0.9 + 200.0 / RANKED_ROWS
    ranks = [end for f in fractions for end in (max(f - room, 0.0), min(f + room, 1.0))]
    for i, c in enumerate(columns):
        value, n = clean_number(c), F.col(f"n{i}")
        parts += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"l{i}"), F.max(value).alias(f"h{i}")]
        out += [f"n{i}", f"l{i}", f"h{i}"]
        if fractions:
            parts.append(F.kll_sketch_agg_double(value, SKETCH).alias(f"k{i}"))
            out.append(F.when(n > 0, F.kll_sketch_get_quantile_double(f"k{i}", F.array(*map(F.lit, ranks)))).alias(f"e{i}"))
    names = [f"x{i}" for i, _ in enumerate(extra)]
    row = df.agg(*parts, *[x.alias(name) for name, x in zip(names, extra, strict=True)]).select(*out, *names).first()
    facts = {}
    for i, c in enumerate(columns):
        ends = row[f"e{i}"] if fractions and row[f"n{i}"] else None
        known = {f: (ends[2 * k], ends[2 * k + 1]) for k, f in enumerate(fractions)} if ends else {}
        facts[c] = Facts(row[f"n{i}"], row[f"l{i}"], row[f"h{i}"], known)
    return facts, row


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], facts: dict[str, Facts] | None = None
) -> DataFrame:
    """(column, fraction, value) with linear interpolation between ranks.

    Nulls and NaN are left out; a column without values gives null. A caller
    that has the facts of the columns can pass them and save a scan.
    """
    columns = list(dict.fromkeys(columns))
    facts = facts or column_facts(df, columns, fractions)[0]
    targets, wanted = [], []
    for c in columns:
        n = facts[c].count
        for f in fractions:
            if n:
                position = f * (n - 1)
                first = math.floor(position)
                targets.append((c, float(f), len(wanted), float(position - first)))
                wanted.append((c, first, min(first + 1, n - 1), f))
            else:
                targets.append((c, float(f), -1, 0.0))
    plan = frame_from_rows(df.sparkSession, targets, "column string, fraction double, wanted int, share double")
    if not wanted:
        return plan.select("column", "fraction", F.lit(None).cast("double").alias("value"))
    ranked = _ranked(df, _brackets(df, wanted, facts))
    value = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("share")
    return plan.join(ranked, "wanted", "left").select("column", "fraction", value.alias("value"))


def value_at_rank(df: DataFrame, column: str, rank: int) -> DataFrame:
    """One row, one column ``value``: the value at a rank counted from 0."""
    facts, _ = column_facts(df, [column], ())
    if not 0 <= rank < facts[column].count:
        raise ValueError(f"rank {rank} is outside the {facts[column].count} values")
    ranked = _ranked(df, _brackets(df, [(column, rank, rank, None)], facts))
    return ranked.select(F.col("lower").alias("value"))
