"""Feature encodings as lists of named column expressions, for use in one ``select``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart import config as C


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def one_hot(c: str, vocabulary, prefix: str, unknown: bool = False) -> list[Column]:
    columns = [flag(F.col(c) == v).alias(f"{prefix}_{C.slug(v)}") for v in vocabulary]
    if unknown:
        columns.append(F.col(c).isNull().cast("int").alias(f"{prefix}_unknown"))
    return columns


def multi_hot(c: str, vocabulary, prefix: str, count_as: str | None = None) -> list[Column]:
    listed = F.split(F.col(c), ",")
    flags = [flag(F.array_contains(listed, v)) for v in vocabulary]
    columns = [f.alias(f"{prefix}_{C.slug(v)}") for f, v in zip(flags, vocabulary)]
    if count_as:
        # every vocabulary entry counts once, however often the list repeats it
        known = F.array(*[F.lit(v) for v in vocabulary])
        distinct = F.size(F.array_intersect(F.coalesce(listed, F.array().cast("array<string>")), known))
        columns.append(distinct.cast("int").alias(count_as))
    return columns


def ordinal(c: Column, ranks: dict) -> Column:
    """Rank of a known category, else null."""
    pairs = [F.lit(x) for item in ranks.items() for x in item]
    return F.element_at(F.create_map(*pairs), c)


def starts(c: str, yes: str, no: str) -> Column:
    return F.when(F.col(c).startswith(yes), 1).when(F.col(c).startswith(no), 0)


def ratio(top, bottom, dtype: str = "float") -> Column:
    """Quotient, null for a zero or null denominator."""
    return F.try_divide(F.col(top), F.col(bottom)).cast(dtype)
