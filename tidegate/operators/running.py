"""Running totals per group that stay balanced when one group holds much of the data.

A window over `(group, order)` sorts a whole group in one task. Groups above `hot_rows` rows
are therefore cut into ranges of the order key first. Each range is summed on its own, and
the total of the ranges before it is added to the rows' running total. Groups below the bound
take the ordinary window, so data without hot groups pays for one count and no join.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidegate.functions.keys import ntz_to_micros
from tidegate.session import freeze

HOT_ROWS = 2_000_000
BROADCAST_BYTES = 16 << 20
MIN_PARTS = 64

_SLICE = "_slice"


@dataclass(frozen=True)
class Slices:
    """How the hot groups are cut: one small table per depth, none when no group is hot.

    Each row of a table names a group (and the range it already lies in) with the order
    column to cut by, the bounds of that column there, a pivot and the number of parts.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    levels: tuple[DataFrame, ...] = ()


def _position(df: DataFrame, name: str) -> Column:
    """An order column as an exact number that sorts the same way."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        return ntz_to_micros(F.col(name))
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.col(name).cast("double")
    raise TypeError(f"order column {name} must be numeric, a date or a timestamp, not {kind}")


def _finite(df: DataFrame, name: str) -> Column:
    """The position where it has a finite value; other values sort to either end."""
    pos = _position(df, name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(pos.between(-sys.float_info.max, sys.float_info.max), pos)
    return pos


def _kinds(df: DataFrame, name: str) -> Column:
    """How many of these a column takes: null, finite values, and each infinity and NaN."""
    pos = _position(df, name)
    kinds = [pos.isNull(), _finite(df, name).isNotNull()]
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        kinds += [pos == F.lit(float(x)) for x in ("-inf", "inf", "nan")]
    return reduce(lambda a, b: a + b, [F.max(F.coalesce(k, F.lit(False)).cast("int"))
                                       for k in kinds])


def _same(names: list[str], suffix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(n + suffix)) for n in names])


def _into_slices(df: DataFrame, slices: Slices, only_depth: int | None = None) -> DataFrame:
    """Add the range each row lies in: a list of part numbers, empty outside hot groups.

    With `only_depth`, only the rows that are cut at that depth remain.
    """
    out = df.withColumn(_SLICE, F.array().cast("array<bigint>"))
    for depth, level in enumerate(slices.levels):
        join_on = [*slices.keys, _SLICE]
        level = level.select(*[F.col(c).alias(c + "_cut") if c in join_on else F.col(c)
                               for c in level.columns])
        joined = out.join(level, _same(join_on, "_cut"),
                          "inner" if depth == only_depth else "left")
        part = F.lit(0).cast("long")
        for i, name in enumerate(slices.order):
            part = F.when(F.col("_by") == i, _part(_position(out, name), i)).otherwise(part)
        out = joined.select(
            *df.columns,
            F.when(F.col("_by").isNull(), F.col(_SLICE))
            .otherwise(F.concat(_SLICE, F.array(part))).alias(_SLICE))
    return out


def _part(pos: Column, i: int) -> Column:
    """Part of a cut by order column `i`: nulls, what is below all finite values, equal widths up
    to the pivot, the pivot itself, equal widths beyond it, what is above all, and NaN."""
    lo, pivot, hi, parts = (F.col(c) for c in (f"_lo{i}", f"_pivot{i}", f"_hi{i}", "_parts"))
    inside = F.greatest(F.least(pos, hi), lo)

    def step(start: Column, end: Column) -> Column:
        # Doubles where the span is more than a long can hold: coarser, in the same order.
        wide = F.try_subtract(end, start).isNull()

        def gap(to: Column) -> Column:
            return F.when(wide, to.cast("double") - start.cast("double")).otherwise(
                F.try_subtract(to, start).cast("double"))
        return F.least(F.try_divide(gap(inside), gap(end) / parts), parts - 1)

    return (F.when(pos.isNull(), -2.0).when(F.isnan(pos.cast("double")), 2 * parts + 3)
            .when(lo.isNull(), F.when(pos > 0, 2 * parts + 2).otherwise(-1.0))
            .when(pos < lo, -1.0).when(pos > hi, 2 * parts + 2)
            .when(inside < pivot, step(lo, pivot))
            .when(inside == pivot, parts).otherwise(parts + 1 + step(pivot, hi))).cast("long")


def find_slices(rows: DataFrame, keys: list[str], order: list[str],
                hot_rows: int = HOT_ROWS) -> Slices:
    """Count the groups and cut those above `hot_rows` rows, again and again while a range
    stays above it and its rows still differ in an order column.

    Runs a job: one count with map-side combine, over the key columns only; the order columns
    are read when a group is hot. `rows` may also be a cheaper superset of the rows that are
    ranked later.
    """
    if hot_rows <= 0:
        raise ValueError(f"hot_rows must be positive, got {hot_rows}")
    narrow = rows.select(*keys, *order)
    for name in order:
        _position(narrow, name)
    slices = Slices(tuple(keys), tuple(order))
    if narrow.groupBy(*keys).count().where(F.col("count") > hot_rows).isEmpty():
        return slices
    while True:
        # The pivot is the value of a row drawn at random, so one that many rows share is
        # soon a part of its own. The draw is settled when the level is frozen.
        drawn = _into_slices(narrow, slices, len(slices.levels) - 1).withColumn("_draw", F.rand())
        cells = drawn.groupBy(*keys, _SLICE).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[of(_finite(narrow, c)).alias(f"{name}{i}") for i, c in enumerate(order)
              for name, of in (("_lo", F.min), ("_hi", F.max),
                               ("_pivot", lambda col: F.max_by(col, "_draw")))],
            *[_kinds(narrow, c).alias(f"_kinds{i}") for i, c in enumerate(order)])
        # At most (rows / hot_rows) entries.
        level = freeze(_cuts(cells, keys, len(order), hot_rows))
        if level.isEmpty():
            return slices
        level = _broadcast_checked(level)
        slices = Slices(slices.keys, slices.order, (*slices.levels, level))


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Freeze a small aggregate, and mark it for broadcast if its size allows that."""
    return _broadcast_checked(freeze(df))


def _broadcast_checked(frozen: DataFrame) -> DataFrame:
    """Sizes are those of the texts and 16 bytes for each column."""
    texts = [F.octet_length(f.name) for f in frozen.schema if isinstance(f.dataType, T.StringType)]
    size = reduce(lambda a, b: a + F.coalesce(b, F.lit(0)), texts,
                  F.lit(16 * len(frozen.columns))).cast("long")
    total = frozen.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(frozen) if total <= BROADCAST_BYTES else frozen


def _cuts(cells: DataFrame, keys: list[str], n_order: int, hot_rows: int) -> DataFrame:
    """The cells to cut: by their first order column that takes more than one value, of which
    null is one."""
    by = F.lit(None).cast("int")
    for i in reversed(range(n_order)):
        differs = F.col(f"_lo{i}") < F.col(f"_hi{i}")
        by = F.when(differs | (F.col(f"_kinds{i}") > 1), F.lit(i)).otherwise(by)
    pivots = {f"_pivot{i}": F.coalesce(f"_pivot{i}", f"_lo{i}") for i in range(n_order)}
    return (
        cells.where(F.col("_rows") > hot_rows)
        .withColumns({"_by": by, **pivots, "_parts": F.greatest(
            F.ceil(F.col("_rows") / hot_rows), F.lit(MIN_PARTS)).cast("double")})
        .where("_by is not null").drop("_rows", *[f"_kinds{i}" for i in range(n_order)]))


def running_total(rows: DataFrame, keys: list[str], order: list[str], out: str,
                  weight: Column | None = None, slices: Slices | None = None,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `out`: the total of `weight` (default 1, which numbers the rows from 1) over the
    rows of the group up to and including this one. `order` must be a total order.

    `slices` from an earlier `find_slices` are reused when given; their keys may be a subset
    of `keys`.
    """
    if slices is None:
        slices = find_slices(rows, keys, order, hot_rows)
    if not slices.levels:
        return rows.withColumn(out, _over(Window.partitionBy(*keys).orderBy(*order), weight))

    weight_col = F.lit(1).cast("long") if weight is None else weight
    weighed = rows.withColumn("_weight", weight_col)
    cut = _into_slices(weighed, slices)
    cells = (_into_slices(weighed, slices, only_depth=0).groupBy(*keys, _SLICE)
             .agg(F.sum("_weight").alias("_total")))
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(
        Window.unboundedPreceding, -1)
    join_on = [*keys, _SLICE]
    before = cells.select(*[F.col(c).alias(c + "_cell") for c in join_on],
                          F.sum("_total").over(earlier).alias("_before"))
    local = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    return (
        cut.join(before, _same(join_on, "_cell"), "left")
        .withColumn(out, _over(local, None if weight is None else F.col("_weight"))
                    + F.coalesce("_before", F.lit(0)))
        .select(*rows.columns, out))


def _over(window, weight: Column | None) -> Column:
    if weight is None:
        return F.row_number().over(window).cast("long")
    return F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
