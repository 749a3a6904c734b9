"""Document fingerprints: an invertible Bloom lookup sketch of a text's paragraphs.

A paragraph is a line, cut after every ``PARAGRAPH_WORDS`` words so that long lines have several; white space between words does not
count. Its digest is a 64-bit hash that also covers how many equal paragraphs came before. Every digest is added to one
cell in each of ``HASHES`` parts of the sketch; a cell holds a count, the XOR of its digests and the XOR of their check hashes.

Two sketches of one size subtract cell by cell, which cancels all common paragraphs. Peeling takes digests out
of cells that hold one, until the rest is empty: what was taken is the symmetric difference. If peeling gets stuck, both
texts are sketched ``GROWTH`` times larger and tried again; beyond four times the number of digests the sets themselves are compared.
Likeness is the Jaccard similarity that follows from the two counts and the size of the difference.

``fingerprints`` is told the next document of each (descending id, the first after the last): documents are dealt into
ranges of (id, hash of the text), and each range also gets the one text that follows it, so no task sees more than its range, however many rows share an id, a text, or
have none. A null text is empty. Null ids come after all others. Rows with equal ids follow each other in the order of their texts' hashes. Two empty texts are alike (1.0).
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import small_batches, width

PARAGRAPH_WORDS = 8
HASHES = 3
BASE_WIDTH = 8
GROWTH = 4
#: Size of the quantile sketches; the rank error is below a thousandth.
SKETCH = 8_192
LOWEST = -(1 << 63)

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def digests(text: str) -> np.ndarray:
    """64-bit digests of the paragraphs; distinct, since equal paragraphs are numbered."""
    out, seen = [], {}
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        for i in range(0, len(words), PARAGRAPH_WORDS):
            piece = b" ".join(words[i:i + PARAGRAPH_WORDS])
            before = seen.get(piece, 0)
            seen[piece] = before + 1
            out.append(xxhash.xxh3_64_intdigest(piece, before))
    return np.array(out, np.uint64)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _places(keys: np.ndarray, part_width: int) -> list[np.ndarray]:
    """The cell of each key in each part of the sketch."""
    return [(_mix(keys, 0x51ED27 * (i + 1)) % np.uint64(part_width)).astype(np.int64) + i * part_width for i in range(HASHES)]


def _checks(keys: np.ndarray) -> np.ndarray:
    return _mix(keys, 0xC0FFEE) >> np.uint64(32)


class Sketches:
    """Sketches of many documents: one row of cells each."""

    def __init__(self, sets: list[np.ndarray], part_width: int):
        self.part_width = part_width
        n = len(sets)
        keys = np.concatenate(sets) if n else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(n), [len(s) for s in sets])
        cells = n * HASHES * part_width
        self.count = np.zeros(cells, np.int64)
        self.key = np.zeros(cells, np.uint64)
        self.check = np.zeros(cells, np.uint64)
        self.n = n
        self._add(owner, keys, np.ones(len(keys), np.int64))

    def _add(self, owner, keys, sign) -> None:
        checks = _checks(keys)
        for place in _places(keys, self.part_width):
            at = owner * (HASHES * self.part_width) + place
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, checks)

    def minus(self, other: "Sketches") -> "Sketches":
        out = Sketches([], self.part_width)
        out.n, out.count = self.n, self.count - other.count
        out.key, out.check = self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, digest) of what the difference holds, and which rows were emptied."""
        per_row = HASHES * self.part_width
        rows, found = [], []
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            at = at[_checks(self.key[at]) == self.check[at]]
            if not len(at):
                break
            owner, keys, sign = at // per_row, self.key[at], self.count[at]
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])
            owner, keys, sign = owner[first], keys[first], sign[first]
            rows.append(owner)
            found.append(keys)
            self._add(owner, keys, -sign)
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        empty = ~left.reshape(self.n, per_row).any(axis=1)
        none = np.zeros(0, np.int64)
        return np.concatenate(rows or [none]), np.concatenate(found or [none.astype(np.uint64)]), empty

    def text(self, i: int, size: int) -> str:
        """The number of digests and the cells of one document, as hexadecimal digits."""
        at = slice(i * HASHES * self.part_width, (i + 1) * HASHES * self.part_width)
        return (
            f"{size:08x}" + self.count[at].astype(">u4").tobytes().hex() + self.key[at].astype(">u8").tobytes().hex()
            + self.check[at].astype(">u4").tobytes().hex()
        )


def differences(a: list[np.ndarray], b: list[np.ndarray], part_width: int = BASE_WIDTH) -> list[np.ndarray]:
    """Digests that only one of each two sets holds, from the sketches alone."""
    out: list = [None] * len(a)
    todo = np.arange(len(a))
    while len(todo):
        rows, keys, done = Sketches([a[i] for i in todo], part_width).minus(Sketches([b[i] for i in todo], part_width)).peel()
        order = np.argsort(rows, kind="stable")
        split = np.split(keys[order], np.searchsorted(rows[order], np.arange(1, len(todo))))
        for j, i in enumerate(todo):
            if done[j]:
                out[i] = split[j]
            elif part_width * HASHES > 4 * (len(a[i]) + len(b[i])):
                out[i] = np.setxor1d(a[i], b[i])
        todo = np.array([i for i in todo if out[i] is None], np.int64)
        part_width *= GROWTH
    return out


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> list[float]:
    """Jaccard similarity of each two digest sets by subtracting and peeling their sketches."""
    sizes = [len(x) + len(y) for x, y in zip(a, b)]
    return [1.0 if n == 0 else (n - len(d)) / (n + len(d)) for n, d in zip(sizes, differences(a, b))]


def edited(text: str, following: str) -> str:
    """The last half of the text's code points replaced by as many of the first of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _rows(ids: list, texts: list[str], last: str) -> pa.RecordBatch:
    """Result rows; the document that follows the last of them has the text ``last``."""
    own = [digests(t) for t in texts]
    following = own[1:] + [digests(last)]
    changed = [edited(t, u) for t, u in zip(texts, texts[1:] + [last])]
    other = [digests(t) for t in changed]
    a, b = Sketches(own, BASE_WIDTH), Sketches(other, BASE_WIDTH)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]),
        pa.array([a.text(i, len(s)) for i, s in enumerate(own)]),
        pa.array([b.text(i, len(s)) for i, s in enumerate(other)]),
        pa.array(likeness(own, other)),
        pa.array(likeness(own, following)),
    ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _in_order(batches):
    """Rows of a task come by range and in order; a range's last row only serves as a successor."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text, ghost in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "ghost"))):
            text = text or ""
            if ghost:
                if texts:
                    yield _rows(ids, texts, text)
                ids, texts, held = [], [], 0
                continue
            if held > 1 << 22 or len(texts) >= 1024:
                yield _rows(ids, texts, text)
                ids, texts, held = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            held += len(text)
    if texts:
        raise RuntimeError("a range of documents came without its successor")


class Ranges:
    """Ranges of documents in the order (place, hash), each beginning at a bound that is some document's own.

    A bound that very many rows equal has several ranges: all rows of the bound are copies of one text, so any of them may stand in any of the ranges, and what follows a
    range of copies is that same text again. The rows up to the next bound stand in the last of its ranges.
    """

    def __init__(self, bounds: list[tuple[int, int, int]]):
        bounds = sorted(bounds)
        self.place, self.hash = (np.array([b[i] for b in bounds], np.int64) for i in (0, 1))
        self.many = np.array([b[2] for b in bounds], np.int64)
        self.start = np.cumsum(self.many) - self.many
        self.total = int(self.many.sum())
        places, first, n = np.unique(self.place, return_index=True, return_counts=True)
        self.cut = {int(p): (int(f), int(f + k)) for p, f, k in zip(places, first, n) if k > 1 or self.hash[f] != LOWEST}

    def bound_of(self, place: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """Number of the last bound not after each row."""
        found = np.searchsorted(self.place, place, side="right") - 1
        for p in np.intersect1d(place, np.array(list(self.cut), np.int64)):
            lo, hi = self.cut[int(p)]
            at = place == p
            found[at] = lo + np.searchsorted(self.hash[lo:hi], hashed[at], side="right") - 1
        return found

    def range_of(self, place: np.ndarray, hashed: np.ndarray, salt: np.ndarray) -> np.ndarray:
        b = self.bound_of(place, hashed)
        copies = (self.place[b] == place) & (self.hash[b] == hashed)
        return self.start[b] + np.where(copies, salt % self.many[b], self.many[b] - 1)

    def followed(self) -> list[list[int]]:
        """The ranges after which each bound's document comes: the one before its first, and all of its copies'."""
        return [[(int(s) - 1) % self.total, *range(int(s), int(s + m) - 1)] for s, m in zip(self.start, self.many)]


def _cuts(column: str, n: int) -> Column:
    """Values of the column that cut its rows into ``n`` parts of about equal size, exact as 64-bit numbers."""
    found = F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint(column, F.lit(SKETCH)), F.array(*[F.lit(i / n) for i in range(1, n)]))
    return F.when(F.count(column) > 0, found)


def _ranges(keyed: DataFrame, n: int) -> Ranges | None:
    """About ``n`` ranges of equal size. An id that many rows have is cut by the hashes of its texts, a text that many of those have by row numbers.

    The driver receives at most ``n`` ids, and at most ``n`` hashes for each id that holds more than two ranges.
    """
    first, cuts = keyed.agg(F.min("place"), _cuts("place", n)).first()
    if first is None:
        return None
    times = Counter(cuts)
    hot = {p: k for p, k in times.items() if k > 1}
    bounds = [(p, LOWEST, 1) for p in {first, *times} - set(hot)]
    if hot:
        most = max(hot.values()) + 1
        for place, least, found in keyed.where(F.col("place").isin(list(hot))).groupBy("place").agg(F.min("hash"), _cuts("hash", most)).collect():
            k = hot[place] + 1
            hits = Counter([least, *(found[i * most // k - 1] for i in range(1, k))])
            bounds += [(place, h, 1 if c == 1 else c + 1) for h, c in hits.items()]
    return Ranges(bounds)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document with its fingerprint, its edited text's, and their likeness; see the module text."""
    spark = docs.sparkSession
    small_batches(spark)
    n = width(spark)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the complement of an id sorts descending ids first, and null ids (as the lowest) last
    keyed = keyed.select("*", F.bitwise_not(F.coalesce("doc_id", F.lit(LOWEST))).alias("place"), F.xxhash64("text").alias("hash"))
    ranges = _ranges(keyed, n)
    if ranges is None:
        return spark.createDataFrame([], SCHEMA)

    @F.pandas_udf("int")
    def range_of(place, hashed, salt):
        import pandas as pd
        return pd.Series(ranges.range_of(place.to_numpy(), hashed.to_numpy(), salt.to_numpy()).astype(np.int32))

    @F.pandas_udf("array<int>")
    def followed(place, hashed):
        import pandas as pd
        after = ranges.followed()
        return pd.Series([after[i] for i in ranges.bound_of(place.to_numpy(), hashed.to_numpy())])

    bounds = spark.createDataFrame(
        list(zip(ranges.place.tolist(), ranges.hash.tolist())), "place long, least long")
    # of the rows at a bound only the different texts are gathered: one, or those of an id that is no hot one
    heads = (
        keyed.join(F.broadcast(bounds), "place").where(F.col("least").isin(LOWEST) | (F.col("hash") == F.col("least")))
        .groupBy("place", "least").agg(F.array_min(F.collect_set(F.struct("hash", "text")))["text"].alias("text"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", "place", F.col("least").alias("hash"), F.explode(followed("place", "least")).alias("at"), F.lit(True).alias("ghost"))
    )
    dealt = (
        keyed.withColumn("at", range_of("place", "hash", F.monotonically_increasing_id())).withColumn("ghost", F.lit(False))
        .unionByName(heads)
        .repartitionByRange(n, "at")
        .sortWithinPartitions("at", "ghost", "place", "hash", "text")
        .select("doc_id", "text", "ghost")
    )
    return dealt.mapInArrow(_in_order, SCHEMA)
