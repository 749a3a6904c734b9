"""MinHash near-duplicates by an inverted join of signature coordinates, confirmed on full shingle sets.

1. Every text becomes its set of word shingles (64-bit hashes) and a MinHash signature of ``COORDINATES`` values. Texts with
   equal sets form a class at once; only one text of each class goes on.
2. A pair of the wanted similarity agrees in at least ``least`` coordinates but for a chance below ``MISS``. Coordinate values are put in one
   global order, rare ones first (the ``COMMON_VALUES`` most frequent ones, counted over all classes, come last). Two signatures that agree in ``least`` places must share one
   of their first ``COORDINATES - least + 1`` values in that order (prefix filter), so only those are posted.
3. Documents posted under one coordinate-value pair meet; agreements of their whole signatures are counted, and pairs below ``least``, or whose set
   sizes rule the similarity out, are skipped. A list passes on no more than a spanning forest of its pairs. A list longer than ``LIST_ROWS`` is dealt into blocks, and every two blocks meet in a cell of their own.
4. Connected components of these edges hold every wanted link inside. Each component's texts meet again, in cells of at most
   about ``CELL_SHINGLES`` shingles, where sets are intersected exactly. A cell passes on a spanning forest of the confirmed links; pairs already joined in it are skipped.
5. Components of the confirmed links, written back to all texts of each class.

No step lists all pairs of a group, and none drops a pair that could be wanted, apart from the stated chance of MinHash itself.

Texts without words (null, empty, white space) have an empty set and are linked with nothing. A null doc_id is kept as such; its component is
null unless it is linked, and nulls never represent a group that has an id. Rows repeated with one doc_id count as one document if their texts are equal.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import components, missed, small_batches, stored, width

COORDINATES = 64
MISS = 1e-7
COMMON_VALUES = 100_000
COMMON_FROM = 8
LIST_ROWS = 1024
CELL_SHINGLES = 2_000_000
MEMO_WORDS = 100_000
CHUNK = 4096
DIRECT_ROWS = 64
SHORT_LIST = 12
POST_ROWS = 1000
FILTER_BITS = 1 << 26

_draw = np.random.default_rng(20_011)
FACTORS = _draw.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
OFFSETS = _draw.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Words per shingle and the least similarity in percent: 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80

    @property
    def least(self) -> int:
        """The most coordinates that a wanted pair agrees in but for the stated chance."""
        return max(t for t in range(1, COORDINATES) if missed(COORDINATES, self.percent / 100, t) < MISS)

    @property
    def prefix(self) -> int:
        return COORDINATES - self.least + 1


class Words(dict):
    """64-bit hash of each word met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * STEP
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, size: int, words: Words) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; A-Z lower-cased, words cut at ASCII white space."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    run = min(size, len(hashes))
    total = np.full(len(hashes) - run + 1, run, np.uint64)
    for i in range(run):
        total = _mixed(total + hashes[i:len(hashes) - run + 1 + i] * (STEP + np.uint64(2 * i)))
    return np.unique(total)


def signature(found: np.ndarray) -> np.ndarray:
    """32-bit minimum per coordinate."""
    out = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(found), CHUNK):
        x = found[start:start + CHUNK, None] * FACTORS + OFFSETS
        x ^= x >> np.uint64(31)
        x *= STEP
        out = np.minimum(out, (x >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return out


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            sets = [shingles(t, size, words) for t in batch.column("text").to_pylist()]
            marks = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], names=["doc_id", "n", "mark", "sig"])
    return run


def _keys(sig: np.ndarray) -> np.ndarray:
    """One number per coordinate and value."""
    return ((np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)) | sig.astype(np.uint64)).astype(np.int64)


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _value_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_keys(_signatures(batch.column("sig"))).ravel())], names=["value"])


def _sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, for steps that give many rows per row."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _post(common, prefix: int):
    """Postings of each class under the first ``prefix`` of its values in the global order; ``blocks`` by the counts of common values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, places = common.value
        for batch in _sliced(batches, POST_ROWS):
            sigs = _signatures(batch.column("sig"))
            keys = _keys(sigs)
            at = np.minimum(np.searchsorted(values, keys), max(0, len(values) - 1))
            known = values[at] == keys if len(values) else np.zeros(keys.shape, bool)
            # a common value stands after all others, by its frequency; the others stand in the order of their hashes
            late = np.where(known, places[at] if len(values) else 0, 0)
            order = np.lexsort((_mixed(keys.astype(np.uint64)), late), axis=1)[:, :prefix]
            blocks = np.maximum(1, -(-np.take_along_axis(late, order, axis=1) // LIST_ROWS)).ravel()
            n = len(keys)
            small = _mixed(sigs.astype(np.uint64)).astype(np.uint8)
            row = np.repeat(np.arange(n), prefix)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.take_along_axis(keys, order, axis=1).ravel()), batch.column("rep").take(pa.array(row)), batch.column("n").take(pa.array(row)),
                pa.array([s.tobytes() for s in small], pa.binary()).take(pa.array(row)), pa.array(blocks, pa.int64()),
            ], names=["value", "rep", "n", "sig", "blocks"])
    return run


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], columns, short: int = 1):
    """Row ranges of each key that has two rows or more, as slices of what ``columns`` makes of a batch; rows of a key come together.

    Yields (length, arrays): runs of up to ``short`` rows that lie within a batch come stacked by their length, others one by one.
    """
    held: list = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys])
        cuts = np.concatenate([[0], np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1, [ids.shape[1]]])
        values, sizes = columns(batch), np.diff(cuts)
        inner = np.arange(1, len(sizes) - 1)
        for size in range(2, short + 1):
            starts = cuts[inner[sizes[1:-1] == size]]
            if len(starts):
                at = starts[:, None] + np.arange(size)
                yield size, [v[at] for v in values]
        # single rows inside a batch are passed over; the first run may go on from the last batch, the last one into the next
        for r in sorted({0, len(sizes) - 1, *inner[sizes[1:-1] > max(1, short)].tolist()}):
            now = tuple(ids[:, cuts[r]])
            if now != key:
                if sum(len(h[0]) for h in held) > 1:
                    yield 0, [np.concatenate(x) for x in zip(*held)]
                held, key = [], now
            held.append([v[cuts[r]:cuts[r + 1]] for v in values])
    if sum(len(h[0]) for h in held) > 1:
        yield 0, [np.concatenate(x) for x in zip(*held)]


def stacked_edges(reps: np.ndarray, sizes: np.ndarray, sigs: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """As ``list_edges`` for many lists of one length: the first axis is the list."""
    labels, found = np.broadcast_to(np.arange(reps.shape[1]), reps.shape).copy(), []
    for i in range(1, reps.shape[1]):
        for j in range(i):
            small, large = np.minimum(sizes[:, i], sizes[:, j]), np.maximum(sizes[:, i], sizes[:, j])
            at = np.flatnonzero((labels[:, i] != labels[:, j]) & (100 * small >= rule.percent * large))
            at = at[(sigs[at, i] == sigs[at, j]).sum(axis=1) >= rule.least]
            if len(at):
                found += zip(reps[at, i].tolist(), reps[at, j].tolist())
                labels[at] = np.where(labels[at] == labels[at, j][:, None], labels[at, i][:, None], labels[at])
    return found


def _merged(labels: np.ndarray, i: int, j: int) -> bool:
    """Give i's and j's groups one label; whether they were apart."""
    if labels[i] == labels[j]:
        return False
    labels[labels == labels[j]] = labels[i]
    return True


def list_edges(reps: np.ndarray, sizes: np.ndarray, sigs: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of one list that may be wanted: enough agreements, sizes close enough."""
    labels, found = np.arange(len(reps)), []
    for i in range(1, len(reps)):
        fits = 100 * np.minimum(sizes[:i], sizes[i]) >= rule.percent * np.maximum(sizes[:i], sizes[i])
        near = np.flatnonzero(fits & (labels[:i] != labels[i]))
        for j in near[(sigs[near] == sigs[i]).sum(axis=1) >= rule.least]:
            if _merged(labels, i, j):
                found.append((int(reps[i]), int(reps[j])))
    return found


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])


def _meet(rule: Rule):
    def columns(batch):
        sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, COORDINATES)
        return batch.column("rep").to_numpy(), batch.column("n").to_numpy(), sigs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: set = set()
        for size, (reps, sizes, sigs) in _runs(batches, ["value", "x", "y"], columns, SHORT_LIST):
            edges.update((stacked_edges if size else list_edges)(reps, sizes, sigs, rule))
            if len(edges) > 50_000:
                yield _edge_batch(list(edges))
                edges = set()
        yield _edge_batch(list(edges))
    return run


def _confirm(rule: Rule):
    def columns(batch):
        texts = np.empty(batch.num_rows, object)
        texts[:] = batch.column("text").to_pylist()
        return batch.column("rep").to_numpy(), batch.column("side").to_numpy(), texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for _, (reps, sides, texts) in _runs(batches, ["root", "x", "y"], columns):
            yield _edge_batch(links_of(reps, sides, [shingles(t, rule.words, words) for t in texts], rule))
    return run


def links_of(reps: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Spanning forest of the confirmed links of one cell; rows of one block (equal side 1 or 2) meet elsewhere."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    reps, sides, sets = reps[order], sides[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    ids = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(sizes)[:-1])
    marked = np.zeros(int(max(x.max() for x in ids if len(x))) + 1, np.int64)
    sigs = np.array([signature(s) for s in sets]) if len(sets) > DIRECT_ROWS else None
    labels, found = np.arange(len(sets)), []
    for i in range(1, len(sets)):
        low = int(np.searchsorted(100 * sizes[:i], rule.percent * sizes[i]))
        near = low + np.flatnonzero((labels[low:i] != labels[i]) & ((sides[low:i] == 0) | (sides[low:i] != sides[i])))
        if sigs is not None:
            near = near[(sigs[near] == sigs[i]).sum(axis=1) >= rule.least]
        if not len(near):
            continue
        marked[ids[i]] = 1
        starts = np.cumsum(sizes[near]) - sizes[near]
        common = np.add.reduceat(marked[np.concatenate([ids[j] for j in near])], starts)
        marked[ids[i]] = 0
        for j in near[100 * common >= rule.percent * (sizes[near] + sizes[i] - common)]:
            if _merged(labels, i, j):
                found.append((int(reps[i]), int(reps[j])))
    return found


def _celled(rows: DataFrame, blocks: str, scatter) -> DataFrame:
    """Each row once per cell that its block takes part in; a group of one block has one cell."""
    block = F.pmod(scatter, F.col(blocks))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1), lambda o: F.struct(
        F.least(block, o).alias("x"), F.greatest(block, o).alias("y"), F.when(block == o, 0).when(block < o, 1).otherwise(2).alias("side")))
    return rows.withColumn("cell", F.explode(every)).select("*", "cell.x", "cell.y", "cell.side").drop("cell", blocks)


def classes(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, mark) of every row, and one representative (mark, rep, n, sig) per distinct non-empty set."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = stored(rows.mapInArrow(_set_rows(rule.words), "doc_id long, n long, mark binary, sig binary"), "sets")
    reps = sets.where("mark is not null and doc_id is not null").groupBy("mark").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    return sets.drop("sig"), stored(reps, "classes")


def candidate_edges(reps: DataFrame, rule: Rule) -> DataFrame:
    """Edges (a, b) between representatives; every wanted link lies within one of their components."""
    spark = reps.sparkSession
    counts = reps.select("sig").mapInArrow(_value_rows, "value long").groupBy("value").count().where(F.col("count") >= COMMON_FROM)
    counts = stored(counts, "values")
    # as Arrow: the tasks merge their firsts, where toPandas() would have the driver take those of every task as objects
    top = counts.orderBy(F.desc("count"), "value").limit(COMMON_VALUES).toArrow().sort_by("value")
    common = spark.sparkContext.broadcast((top["value"].to_numpy(), top["count"].to_numpy()))
    posted = reps.mapInArrow(_post(common, rule.prefix), "value long, rep long, n long, sig binary, blocks long")
    longer = counts.where(F.col("count") > LIST_ROWS)
    if longer.count() > COMMON_VALUES:
        # more long lists than values that every task knows the counts of
        rest = longer.select("value", F.ceil(F.col("count") / LIST_ROWS).alias("counted"))
        posted = posted.join(rest, "value", "left").withColumn("blocks", F.coalesce("counted", "blocks")).drop("counted")
    cells = _celled(posted, "blocks", F.xxhash64("rep"))
    dealt = cells.drop("side").repartition(width(spark), "value", "x", "y").sortWithinPartitions("value", "x", "y", "rep")
    return dealt.mapInArrow(_meet(rule), "a long, b long")


def marked(rows: DataFrame, rule: Rule) -> DataFrame:
    """The rows with the mark of their text's set in a new last column ``set_mark``, null for an empty set."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", set_mark binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            sets = (shingles(t, rule.words, words) for t in batch.column("text").to_pylist())
            marks = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], names=[*batch.schema.names, "set_mark"])
    return rows.mapInArrow(run, schema)


def may_hold(ids: DataFrame, column: str):
    """A filter on a column: true for every id of ``ids``, false for most others. One bit per hash, so its size does not depend on the number of ids."""
    place = f"pmod(xxhash64({column}), {FILTER_BITS}L)"
    marks = ids.selectExpr(f"{place} as p").selectExpr("shiftright(p, 6) as word", "shiftleft(1L, cast(p % 64 as int)) as bit")
    words = marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = ids.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def held(places: pd.Series) -> pd.Series:
        p = places.to_numpy(np.int64)
        return pd.Series(shared.value[p >> 6] >> (p & 63) & 1 == 1)
    return held(F.expr(place))


def class_texts(docs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """``members`` (rep, doc_id, mark, root, blocks) with one text of the class each: rows repeated under an id count once, those of its other classes not.

    Only texts whose id may be a member's are shuffled, and repeated ones are combined before.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    near = marked(rows.where(may_hold(members, "doc_id")), rule).where("set_mark is not null")
    own = near.groupBy("doc_id", F.col("set_mark").alias("mark")).agg(F.min("text").alias("text"))
    return own.join(members, ["doc_id", "mark"]).select("rep", "root", "blocks", "text")


def confirmed_links(docs: DataFrame, reps: DataFrame, groups: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) whose full sets reach the similarity; within each group no more than a spanning forest per cell."""
    spark = docs.sparkSession
    members = groups.join(reps.select(F.col("rep").alias("id"), F.col("rep").alias("doc_id"), "mark", "n"), "id")
    sums = members.groupBy("component").agg(F.ceil(F.sum("n") * 2 / CELL_SHINGLES).alias("blocks"))
    members = stored(members.join(sums, "component").select(F.col("id").alias("rep"), "doc_id", "mark", F.col("component").alias("root"), "blocks"), "members")
    cells = _celled(class_texts(docs, members, rule), "blocks", F.xxhash64("rep"))
    dealt = cells.repartition(width(spark), "root", "x", "y").sortWithinPartitions("root", "x", "y", "rep")
    return dealt.mapInArrow(_confirm(rule), "a long, b long")


def deduplicate(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept (whether it is its component's smallest id)."""
    small_batches(docs.sparkSession)
    sets, reps = classes(docs, rule)
    groups = components(candidate_edges(reps, rule), "a", "b", "candidates")
    links = components(confirmed_links(docs, reps, groups, rule), "a", "b", "links")
    heads = reps.join(links.withColumnRenamed("id", "rep"), "rep", "left").select("mark", F.coalesce("component", "rep").alias("head"))
    alone = sets.where("mark is null").withColumn("head", F.lit(None).cast("long"))
    out = sets.where("mark is not null").join(heads, "mark", "left").unionByName(alone).withColumn("component_id", F.coalesce("head", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
