"""Reference bins, bin shares and the population stability index, for many variables and groups at once.

Everything is in long form (keys, variable, bin): a variable with few values far from its deciles gets
one bin per distinct value, so the number of bins has no bound and must not sit in one array.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.operators.ordered import interpolated, running_totals
from riskmart.sources.tables import stored

MISSING = -1
# Edges that a row is compared with one by one; edges in a block, and blocks, of variables with more.
DIRECT_EDGES = 12
ARRAY_EDGES = 64
ARRAY_BLOCKS = 512
# Size of the rank sketch, and the width of a bracket to each side of a rank in steps of 1 / ACCURACY.
ACCURACY = 2000
MARGIN = 4


def melt(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, variable, value): numeric columns in long form, NaN as null."""
    values = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns]
    return df.select(*keys, *values).unpivot(keys, columns, "variable", "value")


def brackets(long: DataFrame, keys: list[str], fractions: list[float]) -> DataFrame:
    """One row per variable and model version: (keys, _nulls, _low, _high, _wide).

    A sketch brackets each wanted rank from both sides, the smallest and largest value being known exactly. ``_wide`` marks variables whose ranks may all be
    one of these two: every bracket but the outermost reaches the smallest or the largest value. A variable without values has no brackets.
    """
    inner = [f for f in fractions if 0 < f < 1]
    ends = [min(max(f + side * MARGIN / ACCURACY, 0.0), 1.0) for f in inner for side in (-1, 1)]
    sketch = long.groupBy(*keys).agg(
        F.count_if(F.col("value").isNull()).alias("_nulls"), F.min("value").alias("_min"), F.max("value").alias("_max"),
        F.percentile_approx("value", ends, ACCURACY).alias("_ends"))
    low = ["_min", *[F.col("_ends")[2 * i] for i in range(len(inner))], "_max"]
    high = ["_min", *[F.col("_ends")[2 * i + 1] for i in range(len(inner))], "_max"]
    reach = reduce(Column.__and__, [(a <= F.col("_min")) | (b >= F.col("_max")) for a, b in zip(low[1:-1], high[1:-1])], F.lit(True))
    return sketch.select(
        *keys, "_nulls", F.when(F.col("_min").isNotNull(), F.array(*low)).alias("_low"), F.array(*high).alias("_high"),
        F.coalesce((F.col("_min") < F.col("_max")) & reach, F.lit(False)).alias("_wide"))


def near_ranks(long: DataFrame, keys: list[str], fractions: list[float], found: DataFrame | None = None) -> DataFrame:
    """(keys, value, _n, _own): rows per value near the wanted ranks, all other rows counted with the next such value below.

    Rows outside all brackets move to the upper end of the bracket below them, which leaves the ranks inside brackets as they are; ``_own`` counts the rows that
    did not move. About 2 * MARGIN / ACCURACY of the rows per fraction keep their value, the others are combined before the shuffle. Variables
    marked as wide keep all their values.
    """
    found = brackets(long, keys, fractions) if found is None else found
    count = len([f for f in fractions if 0 < f < 1]) + 2
    # a column for each end: comparisons of columns stay in generated code, functions over arrays do not
    high = lambda i: F.when(F.col("_wide"), F.array_max("_high")).otherwise(F.col("_high")[i])
    ends = found.where("_low is not null").select(
        *keys, *[F.col("_low")[i].alias(f"_low{i}") for i in range(count)], *[high(i).alias(f"_high{i}") for i in range(count)])
    value = F.col("value")
    # in a bracket the value itself, above it the bracket's end; the first bracket holds the smallest value
    nearest = [F.when(value >= F.col(f"_low{i}"), F.least(value, F.col(f"_high{i}"))) for i in range(count)]
    marked = long.where(value.isNotNull()).join(F.broadcast(ends), keys).select(*keys, "value", F.greatest(*nearest).alias("_at"))
    counts = marked.groupBy(*keys, "_at").agg(F.count("*").alias("_n"), F.count_if(F.col("_at") == value).alias("_own"))
    return counts.withColumnRenamed("_at", "value")


def _deciles(long: DataFrame, keys: list[str], fractions: list[float], found: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(keys, n, e: distinct deciles with the rows below each, missed), and the running counts where a variable is wide."""
    runs = running_totals(near_ranks(long, keys, fractions, found), keys, "value", ["_n", "_own"])
    wide = not found.where("_wide").isEmpty()
    if wide:
        runs = stored(runs, "runs")
    ranks = interpolated(runs, keys, "value", fractions, own="_own")
    missed = (F.size("quantiles") < len(fractions)) | F.exists("quantiles", lambda q: q.isNull())
    points = F.arrays_zip(F.col("quantiles").alias("edge"), F.col("below").alias("below"))
    return stored(ranks.select(*keys, "n", F.array_distinct(points).alias("e"), missed.alias("missed")), "deciles"), runs if wide else None


def profile(long: DataFrame, keys: list[str], bins: int = 10) -> tuple[DataFrame, DataFrame]:
    """Of the reference values, column ``value``: (keys, edge_no from 1, edge), the inner bin edges, and (keys, bin, n, proportion), the rows of each bin.

    Edges are the distinct deciles without the outermost two. With at most two distinct deciles the edges are the
    midpoints between all neighbouring distinct values. Constant or empty variables have no inner edge.
    Only rows near a decile are sorted. All distinct values are gathered for variables that may have two distinct deciles, and for those
    where a decile fell outside its bracket, so the result is exact whatever the sketch gave. The ranks of the edges give the rows between
    them, so the rows are not read again to count bins. Empty bins are left out; missing values are in bin -1.
    """
    fractions = [i / bins for i in range(bins + 1)]
    found = stored(brackets(long, keys, fractions), "brackets")
    deciles, runs = _deciles(long, keys, fractions, found)
    parts = [(deciles.where(~F.col("missed")), runs)]
    again = deciles.where("missed")
    if not again.isEmpty():
        whole = found.drop("_wide").join(again.select(*keys), keys, "left_semi").withColumn("_wide", F.lit(True))
        parts.append(_deciles(long, keys, fractions, stored(whole, "brackets")))
    edges = reduce(DataFrame.unionByName, [_edges(*part, keys) for part in parts])
    counts = reduce(DataFrame.unionByName, [_held(*part, keys) for part in parts])
    nulls = found.where("_nulls > 0").select(*keys, F.lit(MISSING).cast("long").alias("bin"), F.col("_nulls").alias("n"))
    totals = reduce(DataFrame.unionByName, [d.select(*keys, F.col("n").alias("_known")) for d, _ in parts])
    rows = found.join(totals, keys, "left").select(*keys, (F.col("_nulls") + F.coalesce("_known", F.lit(0))).alias("_rows"))
    shares = counts.where("n > 0").unionByName(nulls).join(F.broadcast(rows), keys)
    return edges, shares.select(*keys, "bin", "n", (F.col("n") / F.col("_rows")).alias("proportion"))


def decile_edges(long: DataFrame, keys: list[str], bins: int = 10) -> DataFrame:
    """Inner bin edges of the reference values: (keys, edge_no from 1, edge); see ``profile``."""
    return stored(profile(long, keys, bins)[0], "edges")


def _wide_runs(deciles: DataFrame, runs: DataFrame, keys: list[str]) -> DataFrame:
    """Running counts of the variables with two distinct deciles; a variable is a column, a key a model version."""
    return runs.join(F.broadcast(deciles.where(F.size("e") == 2).select(*keys)), keys, "left_semi")


def _edges(deciles: DataFrame, runs: DataFrame | None, keys: list[str]) -> DataFrame:
    inner = deciles.where(F.size("e") > 2).select(
        *keys, F.posexplode(F.slice("e", F.lit(2), F.size("e") - 2)).alias("_i", "_e")
    ).select(*keys, (F.col("_i") + 1).cast("long").alias("edge_no"), F.col("_e.edge").alias("edge"))
    if runs is None:
        return inner
    middle = _wide_runs(deciles, runs, keys).where(F.col("prev_value").isNotNull()).select(
        *keys, (F.col("place") - 1).alias("edge_no"), ((F.col("prev_value") + F.col("value")) / 2).alias("edge"))
    return inner.unionByName(middle)


def _held(deciles: DataFrame, runs: DataFrame | None, keys: list[str]) -> DataFrame:
    """(keys, bin, n): rows of each bin, from the rows below its two edges; where edges are midpoints each value has a bin."""
    start = F.array(F.lit(0).cast("long"))
    inner = F.when(F.size("e") > 2, F.transform(F.slice("e", F.lit(2), F.size("e") - 2), lambda e: e["below"])).otherwise(F.array().cast("array<bigint>"))
    bounds = deciles.where(F.size("e") != 2).select(*keys, F.concat(start, inner, F.array("n")).alias("_b"))
    few = bounds.select(*keys, F.posexplode(F.transform(F.slice("_b", F.lit(2), F.size("_b") - 1), lambda b, i: b - F.get("_b", i))).alias("bin", "n"))
    few = few.select(*keys, F.col("bin").cast("long").alias("bin"), "n")
    if runs is None:
        return few
    return few.unionByName(_wide_runs(deciles, runs, keys).select(*keys, (F.col("place") - 1).alias("bin"), F.col("_n").alias("n")))


def bin_counts(long: DataFrame, edges: DataFrame, keys: list[str], edge_keys: list[str]) -> DataFrame:
    """(keys, bin, n): rows per bin, left-closed; null values in bin -1.

    ``edge_keys`` (part of ``keys``) say which edges apply. Variables with few edges look their bin up in
    as many columns, without a shuffle of the rows. The edges of the others are cut into at most ARRAY_BLOCKS blocks of one size: an array of the blocks' first edges
    gives a distinct value its block, and the values, counted, are joined with the edges of their block.
    The counts are stored: they are small beside the rows and are read several times.
    """
    most = edges.groupBy(*edge_keys).agg(F.max("edge_no").alias("_edges"))
    size = F.when(F.col("_edges") <= DIRECT_EDGES, 1).otherwise(F.greatest(F.lit(ARRAY_EDGES), F.ceil(F.col("_edges") / ARRAY_BLOCKS)))
    sized = edges.join(F.broadcast(most.withColumn("_size", size.cast("long"))), edge_keys).withColumn("_block", F.expr("(edge_no - 1) div _size + 1"))
    blocks = stored(sized.groupBy(*edge_keys, "_edges", "_size", "_block").agg(F.array_sort(F.collect_list("edge")).alias("_inner")), "blocks")
    # per variable and version: the edges where they are few, or the first edges of at most 512 blocks
    lookup = blocks.groupBy(*edge_keys, "_edges", "_size").agg(F.array_sort(F.collect_list(F.array_min("_inner"))).alias("_e"))
    few = lookup.select(*edge_keys, (F.col("_edges") > DIRECT_EDGES).alias("_many"), *[F.get("_e", F.lit(i)).alias(f"_e{i}") for i in range(DIRECT_EDGES)])
    value, many = F.col("value"), F.coalesce("_many", F.lit(False)) & F.col("value").isNotNull()
    passed = reduce(Column.__add__, [F.when(value >= F.col(f"_e{i}"), 1).otherwise(0) for i in range(DIRECT_EDGES)])
    position = F.when(value.isNull(), MISSING).otherwise(passed).cast("long")
    marked = long.join(F.broadcast(few), edge_keys, "left")
    wide = blocks.where(F.col("_edges") > DIRECT_EDGES)
    if wide.isEmpty():
        return stored(marked.groupBy(*keys, position.alias("bin")).agg(F.count("*").alias("n")), "bins")

    # one pass for all: a row per bin, and per value where a variable has many edges
    placed = marked.select(*keys, F.when(~many, position).alias("bin"), F.when(many, value).alias("value"))
    cells = stored(placed.groupBy(*keys, "bin", "value").agg(F.count("*").alias("n")), "cells")
    heads = F.broadcast(lookup.where(F.col("_edges") > DIRECT_EDGES))
    found = cells.where(value.isNotNull()).drop("bin").join(heads, edge_keys).withColumn("_block", F.size(F.filter("_e", lambda e: e <= value)).cast("long"))
    within = found.join(wide.select(*edge_keys, "_block", "_inner"), [*edge_keys, "_block"], "left")
    before = (F.col("_block") - 1) * F.col("_size") + F.size(F.filter("_inner", lambda e: e <= value))
    # a value below the first block is below the first edge
    bins = within.select(*keys, F.when(F.col("_block") > 0, before).otherwise(0).cast("long").alias("bin"), "n")
    direct = cells.where(value.isNull()).select(*keys, "bin", "n")
    return stored(direct.unionByName(bins).groupBy(*keys, "bin").agg(F.sum("n").alias("n")), "bins")


def proportions(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, bin, n, proportion): shares of all rows of the group, missing ones included."""
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    return counts.join(totals, keys).select(*keys, "bin", "n", (F.col("n") / F.col("_total")).alias("proportion"))


def with_empty_bins(shares: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """All bins of each variable, empty ones and the missing bin with share 0."""
    ends = shares.select(*keys).distinct().select(*keys, F.explode(F.expr(f"array({MISSING}L, 0L)")).alias("bin"))
    spine = ends.unionByName(edges.select(*keys, F.col("edge_no").alias("bin")))
    return spine.join(shares, keys + ["bin"], "left").select(
        *keys, "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("proportion", F.lit(0.0)).alias("proportion")
    )


def _term(actual, expected):
    return (actual - expected) * F.ln(actual / expected)


def psi(actual: DataFrame, reference: DataFrame, keys: list[str], reference_keys: list[str]) -> DataFrame:
    """(keys, psi, missing_rate, reference_missing); psi is the sum over bins of (a - r) ln(a / r), shares floored.

    ``actual`` and ``reference`` are bin shares; ``reference_keys`` (part of ``keys``) find the reference
    of a group. Reference bins absent from a group are not laid out per group: their terms depend on the
    reference alone, so the sum over all reference bins is corrected by the bins the group does have.
    """
    floor = F.lit(C.PSI_FLOOR)
    r = F.greatest(F.coalesce("_r", F.lit(0.0)), floor)
    absent = _term(floor, r)

    def missing(share):
        return F.coalesce(F.sum(F.when(F.col("bin") == MISSING, F.col(share))), F.lit(0.0))

    bins = reference.select(*reference_keys, "bin", F.col("proportion").alias("_r"))
    whole = bins.groupBy(*reference_keys).agg(F.sum(absent).alias("_all_absent"), missing("_r").alias("reference_missing"))
    joined = actual.join(bins, reference_keys + ["bin"], "left")
    # bins unknown to the reference count as a floored reference share; their absent term is zero
    own = joined.groupBy(*keys).agg(
        F.sum(_term(F.greatest("proportion", floor), r) - absent).alias("_own"),
        missing("proportion").alias("missing_rate"),
    )
    return own.join(whole, reference_keys, "left").select(
        *keys, (F.col("_own") + F.col("_all_absent")).alias("psi"), "missing_rate", "reference_missing",
    )
