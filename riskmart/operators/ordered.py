"""Exact running totals, ranks and quantiles without sorting a whole group in one task.

A running window partitioned by group alone puts a group holding a third of all rows into one task. Here
the rows are first reduced to one row per (group, value); the value axis is then cut into ranges of
about equal row counts. The cut points come from a quantile sketch and only decide the balance: totals of
the earlier ranges are added as an offset, so the results are exact for any cuts. Each
(group, range) cell holds at most about 1/ranges of all rows, whatever the group sizes are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.session import shuffle_width


def _range_of(value: Column, cuts: Column, count: int) -> Column:
    """Number of cut points <= value: first among every step-th cut, then within one step."""
    if count <= 64:
        return F.size(F.filter(cuts, lambda c: c <= value))
    step = math.isqrt(count)
    coarse = F.filter(F.sequence(F.lit(step), F.lit(count), F.lit(step)), lambda i: F.element_at(cuts, i) <= value)
    start = F.size(coarse) * step
    return start + F.size(F.filter(F.slice(cuts, start + 1, step), lambda c: c <= value))


def running_totals(
    df: DataFrame, keys: list[str], order: str, sums: list[str], descending: bool = False, ranges: int | None = None
) -> DataFrame:
    """One row per (keys, order) with ``c``, ``cum_c`` (inclusive) and ``total_c`` for each c in sums,
    ``prev_<order>``, the neighbouring value before it in the chosen direction, and ``place``, its number among
    the distinct values from 1.

    Rows with a null ``order`` are left out.
    """
    ranges = ranges or shuffle_width(df.sparkSession)
    cells = df.where(F.col(order).isNotNull()).groupBy(*keys, order).agg(*[F.sum(c).alias(c) for c in sums])

    # The sums ride along in the subquery so that it shares the shuffle of the main plan.
    fractions = [i / ranges for i in range(1, ranges)]
    sketch = F.percentile_approx(order, fractions, 20 * ranges).alias("cuts")
    cuts = cells.select(F.struct(sketch, *[F.sum(c).alias(c) for c in sums])).scalar().getField("cuts")
    cells = cells.withColumn("_cuts", cuts).withColumn("_one", F.lit(1).cast("long"))
    sums = [*sums, "_one"]
    position = _range_of(F.col(order), F.col("_cuts"), ranges - 1)
    cells = cells.withColumn("_range", -position if descending else position).drop("_cuts")

    # One offset row per (group, range): at most groups x ranges rows.
    far = (F.min if descending else F.max)(order).alias(order)
    per_range = cells.groupBy(*keys, "_range").agg(*[F.sum(c).alias(c) for c in sums], far)
    whole = W.partitionBy(*keys)
    before = whole.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *keys, "_range", F.lit(0).alias("_cell"),
        F.last(order).over(before).alias(order),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast(cells.schema[c].dataType).alias(c) for c in sums],
        *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums],
    )
    rows = cells.withColumn("_cell", F.lit(1)).unionByName(offsets, allowMissingColumns=True)

    sort = F.desc(order) if descending else F.asc(order)
    within = W.partitionBy(*keys, "_range").orderBy("_cell", sort)
    upto = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.select(
        *keys, order, *sums[:-1], "_cell",
        F.lag(order).over(within).alias(f"prev_{order}"),
        F.sum("_one").over(upto).alias("place"),
        *[F.sum(c).over(upto).alias(f"cum_{c}") for c in sums[:-1]],
        *[F.first(f"total_{c}").over(upto).alias(f"total_{c}") for c in sums[:-1]],
    ).where("_cell = 1").drop("_cell")


def quantiles(df: DataFrame, keys: list[str], value: str, fractions: list[float], ranges: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: keys, n, quantiles (array in the order of fractions).

    Groups whose values are all null are absent.
    """
    runs = running_totals(df.withColumn("_n", F.lit(1).cast("long")), keys, value, ["_n"], ranges=ranges)
    return interpolated(runs, keys, value, fractions).drop("below")


def interpolated(runs: DataFrame, keys: list[str], value: str, fractions: list[float], own: str | None = None) -> DataFrame:
    """Quantiles from running counts, with ``below``, the rows less than each; at most two rows per group and fraction pass the first step.

    ``own`` names how many of a row's ``_n`` have its value, counted before the others: a rank among the others gives a null.
    """
    first, n = F.col("cum__n") - F.col("_n"), F.col("total__n")
    last = first + F.col(own or "_n") - 1
    wanted = F.transform(
        F.array(*[F.lit(float(f)) for f in fractions]), lambda f, i: F.struct(i.alias("i"), (f * (n - 1)).alias("at"))
    )
    touched = F.filter(
        wanted, lambda t: F.floor(t["at"]).between(first, last) | F.ceil(t["at"]).between(first, last)
    )
    at = F.col("at")
    ends = runs.select(*keys, value, "_n", *([own] if own else []), "cum__n", "total__n", F.inline(touched)).groupBy(*keys, "i").agg(
        F.max("total__n").alias("n"), F.max(at - F.floor(at)).alias("share"),
        F.max(F.floor(at)).alias("rank"), F.max(F.when(F.floor(at).between(first, last), first)).alias("first"),
        F.max(F.when(F.floor(at).between(first, last), F.col(value))).alias("low"),
        F.max(F.when(F.ceil(at).between(first, last), F.col(value))).alias("high"),
    )
    q = F.col("low") + (F.col("high") - F.col("low")) * F.col("share")
    # between two neighbouring ranks lies no row
    point = F.struct("i", q.alias("q"), F.when(q > F.col("low"), F.col("rank") + 1).otherwise(F.col("first")).alias("below"))
    points = F.sort_array(F.collect_list(point))
    return ends.groupBy(*keys).agg(F.max("n").alias("n"), points["q"].alias("quantiles"), points["below"].alias("below"))
