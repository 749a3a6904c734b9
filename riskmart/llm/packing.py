"""Packing: optimal length buckets from the global histogram, then token-budget batches inside each bucket.

A document's length is its number of words. Documents longer than ``max_length`` are cut into pieces of that length and a rest, so every word is packed and
the histogram has at most ``max_length / step`` bars however long texts get: with a ``step`` of 1, one for each length. Dynamic programming over the histogram chooses at most
``buckets`` upper bounds (multiples of ``step``, so any length by default) with the least padding when each piece is padded to its bucket's bound. The cost obeys the quadrangle
inequality, so the best split moves one way and divide and conquer finds it.

Within a bucket a batch holds as many pieces as fit the token budget at the padded length. Pieces are numbered by a hash order: they are dealt into
slots, numbered within each, and slots are put one after another by a running total over a table of slot sizes. So all batches of a bucket but its last are full, and no task
sees more than a slot. Slots are drawn from the id, the piece and the row's number in the stored pieces, so rows with one id, or none, are spread like all others. Documents
without words (null or empty texts) take no part. Rows repeated with one id are packed each. Which batch of its bucket a row joins depends on how the input is dealt; sizes and padding do not. With no document at all the result is empty.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.llm.shared import stored

MAX_LENGTH = 8192
STEP = 1
BUCKETS = 16
BUDGET = 65_536
SLOT_ROWS = 20_000


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length ranges with the least total padding; lengths ascending and distinct."""
    n = len(lengths)
    if n == 0:
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def cost(i, j):
        """Padded size of the pieces after the i-th and up to the j-th length (i may be an array)."""
        return lengths[j - 1] * (total[j] - total[i])

    best = np.array([0] + [cost(0, j) for j in range(1, n + 1)], np.int64)
    back = []
    for _ in range(1, min(buckets, n)):
        now, come = best.copy(), np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, least, most = todo.pop()
            if low > high:
                continue
            mid = (low + high) // 2
            starts = np.arange(least, min(mid - 1, most) + 1)
            values = best[starts] + cost(starts, mid)
            at = int(np.argmin(values))
            now[mid], come[mid] = values[at], starts[at]
            todo += [(low, mid - 1, least, int(starts[at])), (mid + 1, high, int(starts[at]), most)]
        back.append(come)
        best = now
    bounds, j = [], n
    for come in reversed(back):
        bounds.append(int(lengths[j - 1]))
        j = int(come[j])
        if j == 0:
            break
    if j:
        bounds.append(int(lengths[j - 1]))
    return sorted(set(bounds))


def pieces(docs: DataFrame, max_length: int = MAX_LENGTH, step: int = STEP) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, length (rounded up to ``step``)."""
    words = F.size(F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("words")).where("words > 0")
    cut = counted.select("doc_id", "words", F.explode(F.sequence(F.lit(0), F.expr(f"(words - 1) div {max_length}").cast("int"))).alias("piece"))
    first = F.col("piece").cast("long") * max_length
    rows = cut.select("doc_id", F.col("piece").cast("long").alias("piece"), first.alias("first_word"), F.least(F.lit(max_length), F.col("words") - first).alias("n_words"))
    return rows.withColumn("length", F.ceil(F.col("n_words") / step) * step)


def slot_of():
    return F.pmod(F.xxhash64("doc_id", "piece", "row"), F.col("slots"))


def pack(
    docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, max_length: int = MAX_LENGTH, step: int = STEP, slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Per piece: doc_id, piece, first_word, n_words, bucket (padded length), batch (number within the bucket), position in the batch."""
    if max_length % step:
        raise ValueError("max_length must be a multiple of step")
    spark = docs.sparkSession
    # numbered before it is written: a task that runs again reads the same numbers
    rows = stored(pieces(docs, max_length, step).withColumn("row", F.monotonically_increasing_id()), "pieces")
    bars = rows.groupBy("length").count().orderBy("length").collect()  # at most max_length / step rows
    lengths, counts = np.array([r[0] for r in bars], np.int64), np.array([r[1] for r in bars], np.int64)
    bounds = optimal_bounds(lengths, counts, buckets)
    sizes = [int(counts[(lengths > low) & (lengths <= high)].sum()) for low, high in zip([0, *bounds], bounds)]
    schema = "bucket long, slots long, rows_per_batch long"
    table = [(b, max(1, -(-n // slot_rows)), max(1, budget // b)) for b, n in zip(bounds, sizes)]
    of = F.lit(None).cast("long")
    for bound in reversed(bounds):
        of = F.when(F.col("length") <= bound, F.lit(bound).cast("long")).otherwise(of)
    placed = rows.withColumn("bucket", of).join(F.broadcast(spark.createDataFrame(table, schema)), "bucket")
    slotted = placed.withColumn("slot", slot_of())
    held = slotted.groupBy("bucket", "slot").agg(F.count("*").alias("held"))
    before = held.withColumn("before", F.coalesce(F.sum("held").over(W.partitionBy("bucket").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("held")
    order = W.partitionBy("bucket", "slot").orderBy(F.xxhash64("doc_id", "piece", "row", F.lit(1)), "row", "piece")
    at = F.col("before") + F.row_number().over(order) - 1
    numbered = slotted.join(before, ["bucket", "slot"]).withColumn("at", at)
    return numbered.select(
        "doc_id", "piece", "first_word", "n_words", "bucket", F.expr("at div rows_per_batch").alias("batch"), (F.col("at") % F.col("rows_per_batch")).alias("position"),
    )
