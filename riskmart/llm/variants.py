"""Spelling variants: words at edit distance one by a bit-sliced position index, and the more frequent form that each belongs to.

1. Runs of letters are counted over all texts. Words are those of at least ``letters`` code points that occur ``least`` times.
2. Two words at distance one share their first ``KEY`` code points, or their last ones: the one edit cannot touch both ends of words this long. Each word goes into the
   bucket of its beginning and that of its end. A bucket of more than ``BLOCK`` words is dealt into blocks, and every block meets every other in a cell of its own.
3. In a cell an index has one bitset over its words per (position, letter), and one per length. A word is read once, all words of the cell being compared
   at a time: the set without an error, and the sets with one error that has replaced a letter, or has shifted the rest by one position to the right or left.
   Bits are in order of falling frequency, so the lowest bit of the result is the most frequent near word and the number of bits is how many there are. Words that share
   both ends are counted in the bucket of their beginning only.
4. Counts of all cells of a word are added up. A word's form is its most frequent near word (ties: smallest) if that is ``factor`` times as frequent. Forms are followed to
   the last one by pointer doubling; frequencies rise by the factor along the way, so the number of rounds is bounded by the logarithm of that of the largest count.

Null and empty texts have no words, and a null id counts as an empty one. Repeated rows count each. Words may be of any length.
"""

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import small_batches, stored, width

#: Runs of letters, A-Z being lower-cased before.
RUN = "[a-zÀ-ÿ]"
KEY = 3
BLOCK = 16_384
#: Most large buckets that are broadcast.
WIDE = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def misspelt(doc_id: Column, run: Column, every: int = 199) -> Column:
    """The run without one code point where ``every`` divides the checksum of id and run."""
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(mark, F.length(run).cast("long")).cast("int")
    return F.when(F.pmod(mark, F.lit(every)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, letters: int = 6, least: int = 5, every: int | None = 199) -> DataFrame:
    """(word, n): words of at least ``letters`` code points that occur at least ``least`` times, ``misspelt`` first unless ``every`` is None."""
    text = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(F.col("doc_id").alias("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(f"({RUN}{{{letters},}})"), F.lit(1))).alias("run"))
    word = misspelt(F.col("doc_id"), F.col("run"), every) if every else F.col("run")
    counted = runs.select(word.alias("word")).where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


def _bits(places: list[int], size: int) -> int:
    marks = np.zeros(size, np.uint8)
    marks[places] = 1
    return int.from_bytes(np.packbits(marks, bitorder="little").tobytes(), "little")


class PositionIndex:
    """Bitsets of words per (position, letter) and per length; bit i stands for the i-th word."""

    def __init__(self, words: list[str]):
        at: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            lengths.setdefault(len(word), []).append(i)
            for place, letter in enumerate(word):
                at.setdefault((place, letter), []).append(i)
        self.at = {k: _bits(v, len(words)) for k, v in at.items()}
        self.lengths = {k: _bits(v, len(words)) for k, v in lengths.items()}
        self.all = (1 << len(words)) - 1

    def near(self, word: str, apart_from_key: bool = False) -> int:
        """Words that differ from ``word`` in exactly one inserted, deleted or replaced code point; on demand not those with its first ``KEY`` code points."""
        at, n = self.at, len(word)
        same, replaced, longer, shorter, keyed = self.all, 0, 0, 0, 0
        for i, letter in enumerate(word):
            here = at.get((i, letter), 0)
            # words that have read one letter more, or one less, find this one a position further, or before
            longer = (longer | same) & at.get((i + 1, letter), 0)
            shorter = (shorter & at.get((i - 1, letter), 0)) | same
            right = same & here
            replaced = (replaced & here) | (same ^ right)
            same = right
            if i == KEY - 1:
                keyed = same
            if not (same or replaced or longer or shorter):
                return 0
        longer |= same
        found = (replaced & self.lengths.get(n, 0)) | (longer & self.lengths.get(n + 1, 0)) | (shorter & self.lengths.get(n - 1, 0))
        return found & ~keyed if apart_from_key else found


def near_words(cell: list[tuple[str, int]], asked: list[tuple[str, int]], by_end: bool) -> list[tuple]:
    """(word, n, n_near, best, best_n) of the asked words among those of a cell."""
    cell = sorted(cell, key=lambda w: (-w[1], w[0]))
    index = PositionIndex([w for w, _ in cell])
    out = []
    for word, n in asked:
        found = index.near(word, by_end)
        best = cell[(found & -found).bit_length() - 1] if found else (None, None)
        out.append((word, n, found.bit_count(), *best))
    return out


NEAR = "word string, n long, n_near long, best string, best_n long"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, key, x, y, asked, word, n) come sorted; those of one (place, key, x, y) are a cell."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("place", "key", "x", "y", "asked", "word", "n")))

    out: list[tuple] = []
    for (place, *_), cell in groupby(rows(), itemgetter(0, 1, 2, 3)):
        cell = list(cell)
        out += near_words([r[5:] for r in cell if r[4] != 1], [r[5:] for r in cell if r[4] != 0], place == "end")
        if len(out) > 10_000:
            yield _batch(out)
            out = []
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[]] * 5, schema)], schema=schema)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best, best_n) from (word, n)."""
    spark = words.sparkSession
    small_batches(spark)
    ends = F.array(
        F.struct(F.lit("begin").alias("place"), F.substring("word", 1, KEY).alias("key")),
        F.struct(F.lit("end").alias("place"), F.substring("word", -KEY, KEY).alias("key")),
    )
    placed = words.select("word", "n", F.inline(ends))
    blocks = placed.groupBy("place", "key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    # no more than one in BLOCK / 2 words makes a bucket with more than one block
    wide = stored(blocks.where("blocks > 1"), "wide")
    known = F.broadcast(wide) if wide.count() <= WIDE else wide
    dealt = placed.join(known, ["place", "key"], "left").fillna(1, ["blocks"]).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    # in its own cell a word asks and is asked for; elsewhere it does one of both
    roles = F.concat(
        F.array(F.struct(F.col("own").alias("x"), F.col("own").alias("y"), F.lit(2).alias("asked"))),
        F.transform(F.filter(every, lambda b: b != F.col("own")), lambda b: F.struct(F.col("own").alias("x"), b.alias("y"), F.lit(1).alias("asked"))),
        F.transform(F.filter(every, lambda b: b != F.col("own")), lambda b: F.struct(b.alias("x"), F.col("own").alias("y"), F.lit(0).alias("asked"))),
    )
    cells = dealt.select("place", "key", "word", "n", F.inline(roles))
    sorted_cells = cells.repartition(width(spark), "place", "key", "x", "y").sortWithinPartitions("place", "key", "x", "y")
    found = sorted_cells.mapInArrow(_cells, NEAR)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))).alias("top")
    return found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best).select("word", "n", "n_near", F.col("top.word").alias("best"), (-F.col("top.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words of ``forms`` (word, form): the last form that forms lead to."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(further, "root", "left")
        now = stored(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """Per word of (word, n): word, form, root, n, n_near, form_n."""
    near = neighbours(words)
    is_form = F.col("best_n") >= F.lit(factor) * F.col("n")
    judged = stored(near.select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    last = roots(judged.where("form is not null"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, letters: int = 6, least: int = 5, factor: int = 5, every: int | None = 199) -> DataFrame:
    """Words of the documents with their forms and roots."""
    if letters < 2 * KEY:
        raise ValueError(f"words of fewer than {2 * KEY} letters may share neither end with a near word")
    return variants(stored(vocabulary(docs, letters, least, every), "words"), factor)
