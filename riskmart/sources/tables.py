"""Partitioned Parquet tables: replacements that take effect at once or not at all, and pruned reads.

The rows of a write go to a folder of their own (``commit=<id>/<partition>``), beside the live ones. A manifest names the live folder of every partition; writing the next
manifest is the moment at which a replacement takes effect. A job that fails before leaves folders that no manifest names, and every row as it was. Manifests are
numbered and created only if absent, so of two sessions writing at once the second starts from what the first one left.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskmart.session import run_folder

MANIFESTS = "_live"
COMMIT = "commit"
#: Manifests kept beside the latest one.
KEPT = 10


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, at once with its whole text; False if it is there already."""
    place, files = _place(spark, path)
    if files.exists(place):
        return False
    folder = place.getParent()
    # beside the folder, under a name that readers pass over
    ready = spark._jvm.org.apache.hadoop.fs.Path(folder.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(ready, False)
    out.write(bytearray(text.encode()))
    out.close()
    files.mkdirs(folder)
    try:
        if files.getUri().getScheme() != "file":
            return files.rename(ready, place)
        # a local rename would replace the file, a link does not
        os.link(ready.toUri().getPath(), place.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        files.delete(ready, False)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """File names in a folder; none where it does not exist."""
    place, files = _place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def _read_text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """(number of the last manifest file, the latest whole manifest); a file whose writer broke off is passed over."""
    names = [n for n in names_in(spark, os.path.join(path, MANIFESTS)) if n.endswith(".json")]
    for name in reversed(names):
        try:
            return int(names[-1][:-5]), json.loads(_read_text(spark, os.path.join(path, MANIFESTS, name)))
        except ValueError:
            continue
    return (int(names[-1][:-5]) if names else 0), None


def _partition(folder: str) -> str:
    return folder.split("/", 1)[1]


def _values(folder: str) -> dict:
    return dict(part.split("=", 1) for part in _partition(folder).split("/"))


def write_table(df: DataFrame, path: str, by: list[str], rebalance: bool = True, within: dict | None = None) -> None:
    """Replace the partitions present in the frame, and with ``within`` all those of a range, by the frame's rows.

    ``within`` is {partition column: (first, last)}, inclusive: a partition of the range that has no row any more does not keep old ones. Others stay. The input plan runs
    once: its rows are counted while they are written and compared with what the files hold before the replacement takes effect. ``rebalance`` lets adaptive
    execution size the files: small partitions are merged, one that holds much of the table is split over several tasks; narrow tables that already come by partition do without.
    Replaced folders are deleted afterwards, so a reader that started before may have to start again.
    """
    spark, commit, seen = df.sparkSession, uuid.uuid4().hex, Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    (rows.hint("rebalance", *by) if rebalance else rows).write.option("compression", "zstd").partitionBy(*by).parquet(os.path.join(path, f"{COMMIT}={commit}"))
    fresh = _folders(spark, path, by, commit)
    found = _read_folders(spark, path, df.schema, fresh).count()
    # nothing is observed of an empty plan, and a stage that ran again after a loss may be counted twice: then the plan is counted anew
    if (not found or found != seen.get["n"]) and found != df.count():
        raise IOError(f"{path}: not all rows were written, {found} are there")
    present = set(map(_partition, fresh))

    def replaced(folder: str) -> bool:
        values = _values(folder)
        inside = within is not None and all(str(first) <= values[c] <= str(last) for c, (first, last) in within.items())
        return inside or _partition(folder) in present

    while True:
        number, state = manifest(spark, path)
        live = state["live"] if state else []
        kept = [f for f in live if not replaced(f)]
        content = json.dumps({"live": sorted(kept + fresh), "schema": df.schema.jsonValue()})
        if put_if_absent(spark, os.path.join(path, MANIFESTS, f"{number + 1:09d}.json"), content):
            break
    whole = {f.split("/")[0] for f in kept + fresh}
    gone = {f if f.split("/")[0] in whole else f.split("/")[0] for f in set(live) - set(kept)}
    for old in gone | ({f"{COMMIT}={commit}"} - whole):
        place, files = _place(spark, os.path.join(path, old))
        files.delete(place, True)
    for name in names_in(spark, os.path.join(path, MANIFESTS))[:-KEPT - 1]:
        place, files = _place(spark, os.path.join(path, MANIFESTS, name))
        files.delete(place, False)


def _folders(spark: SparkSession, path: str, by: list[str], commit: str) -> list[str]:
    """Partition folders of one write, relative to the table."""
    place, files = _place(spark, "/".join([path, f"{COMMIT}={commit}", *(f"{c}=*" for c in by)]))
    depth = len(by) + 1
    return ["/".join(s.getPath().toString().split("/")[-depth:]) for s in files.globStatus(place) or []]


def _read_folders(spark: SparkSession, path: str, schema: StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    whole = StructType([*schema.fields, StructField(COMMIT, StringType())])
    return spark.read.schema(whole).option("basePath", path).parquet(*[os.path.join(path, f) for f in folders]).select(*schema.names)


def exists(spark: SparkSession, path: str) -> bool:
    return manifest(spark, path)[1] is not None


def read_range(df: DataFrame, first=None, last=None, column: str = "snapshot_date") -> DataFrame:
    """Rows between two optional, inclusive dates; on a partition column only those folders are read."""
    if first is not None:
        df = df.where(F.col(column) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col(column) <= F.lit(last).cast("date"))
    return df


def read_table(spark: SparkSession, path: str, first=None, last=None, columns=None, column: str = "snapshot_date") -> DataFrame:
    """Live rows of a table, in a range of its month column; partitions outside are not read."""
    state = manifest(spark, path)[1]
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    df = read_range(_read_folders(spark, path, StructType.fromJson(state["schema"]), state["live"]), first, last, column)
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    For reduced intermediate tables that are read several times: computed once, with a short lineage and
    measured size, and still there when an executor is lost.
    """
    path = run_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
