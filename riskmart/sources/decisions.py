"""The log of training decisions: files that are added and never changed.

Each decision of a slot and run month is one small JSON file, created only if its number is free; a later one of the same slot and month has the next number and counts. So
sessions that record at once lose nothing, and whatever follows from the decisions (live versions, events) can be worked out again from the log at any time.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.sources.tables import names_in, put_if_absent

LOG = "registry_log"


def append(spark: SparkSession, root: str, slot: str, month, row: dict) -> int:
    """Record a decision; its number among those of the slot and month."""
    folder = os.path.join(root, LOG, f"{slot}_{month}")
    while True:
        numbers = [int(n[:-5]) for n in names_in(spark, folder) if n.endswith(".json")]
        number = max(numbers, default=0) + 1
        text = json.dumps({**row, "number": number, "entry": uuid.uuid4().hex}, default=str) + "\n"
        if put_if_absent(spark, os.path.join(folder, f"{number:06d}.json"), text):
            return number


def latest(spark: SparkSession, root: str, columns: str) -> DataFrame:
    """The decision that counts per slot and run month: (columns); files whose writer broke off are passed over."""
    names = [c.split()[0] for c in columns.split(", ")]
    if not names_in(spark, os.path.join(root, LOG)):
        return spark.createDataFrame([], columns)
    rows = spark.read.schema(f"{columns}, number int").option("recursiveFileLookup", "true").json(os.path.join(root, LOG)).where("slot is not null and number is not null")
    row = F.struct(*names)
    return rows.groupBy("slot", "trained_on").agg(F.max_by(row, "number").alias("row")).select("row.*")
