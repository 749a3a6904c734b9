"""Raw text sources and bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.sources.tables import read_table, write_table


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Text file with a header, every column a string; doubled quotes inside a value are read back as one."""
    return spark.read.options(header=True, inferSchema=False, escape='"').csv(path)


def ingest(raw: DataFrame, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Bronze: rows of first-of-month dates within the range, as they are, one partition per month.

    One pass over the source for all months. Returns (snapshot_date, n_rows) of the ingested months.
    """
    month = F.col("snapshot_date")
    wanted = month.rlike(r"^\d{4}-\d{2}-01$")
    if first:
        wanted &= month >= first
    if last:
        wanted &= month <= last
    write_table(raw.where(wanted), path, ["snapshot_date"])
    return month_counts(read_bronze(raw.sparkSession, path, first, last))


def read_bronze(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Bronze partitions in a month range; the month is a string."""
    df = read_table(spark, path)
    if first:
        df = df.where(F.col("snapshot_date") >= first)
    if last:
        df = df.where(F.col("snapshot_date") <= last)
    return df


def month_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("snapshot_date").agg(F.count("*").alias("n_rows"))


def contract(tables: dict, required: dict = C.REQUIRED_COLUMNS) -> DataFrame:
    """One row per required column: is it there, and how many rows fill it (one pass per table)."""
    parts = []
    for name, df in tables.items():
        there = [c for c in required[name] if c in df.columns]
        counted = df.agg(*[F.count(c).alias(c) for c in there]) if there else df.agg(F.count("*").alias("_n"))
        lines = [
            F.struct(
                F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                F.lit(int(c in there)).alias("present"),
                (F.col(c) if c in there else F.lit(0).cast("long")).alias("n_filled"),
            )
            for c in required[name]
        ]
        parts.append(counted.select(F.inline(F.array(*lines))))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def require_columns(df: DataFrame, columns, what: str = "table") -> DataFrame:
    """The frame itself; raises when columns are missing (source contract and scoring schema check)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing {len(missing)} columns: {missing[:5]}")
    return df
