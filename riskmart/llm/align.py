"""Alignment of the tokens of two tokenizers on the same bytes, in Arrow arrays from encoding to counts.

1. ``space + text`` is encoded by a byte-level BPE tokenizer (A), ``text`` by a piece tokenizer (B) that adds the space. The lists of ids are flattened, parent
   indices say which document a token is of, and a segmented cumulative sum of token lengths gives the byte offset at which each token ends.
2. An Acero hash join of both sides on (document, end) gives the links: the pairs of an A and a B token that end together. Such ends also cut the tokens into groups.
3. One of two tokens that end together is a suffix of the other, so the id pairs that can ever be linked are known from the vocabularies alone
   (``endings``): their table is bounded by them, and a link is stored as one number. ``Table.group_by`` counts links per batch, Spark adds the counts up.
4. The corpus-wide counts, no more than ``endings`` has pairs, are broadcast; a second pass over the stored links adds per document what its links count.

Texts are encoded once. A null or empty text, and one whose joined token bytes differ from ``space + text`` on either side (such as a text that holds U+2581),
has no tokens: zeros and an empty ``groups``. Every row counts, repeated ones and those without an id too. Tokenizer files are read by the driver and travel as broadcasts.

A's ids are worked out from the merge ranks in its file where it is a plain byte-level BPE without normalizer whose ids are in merge order, which gives
the ids of its library faster; otherwise by that library.
"""

import functools
import hashlib
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import small_batches, stored

ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<int>"
#: Characters that are encoded together; a longer text goes alone.
CHUNK_CHARS = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the others counted up from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE tokenizer from the content of its JSON file; ``tokens`` are the bytes of each id."""

    def __init__(self, content: str):
        described = json.loads(content)
        model, letters = described["model"], byte_letters()
        special = {t["id"]: t["content"] for t in described["added_tokens"]}
        names = {i: t for t, i in model["vocab"].items()} | special
        self.tokens = [names[i].encode() if i in special else bytes(map(letters.__getitem__, names[i])) for i in range(len(names))]
        merged = ("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
        cut = described["pre_tokenizer"]
        plain = described["normalizer"] is None and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        if plain and all(model["vocab"][m] == 256 + i for i, m in enumerate(merged)):
            import tiktoken
            ranks = {t: i for i, t in enumerate(self.tokens) if i not in special}
            self.encode_one = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            tokenizer = Tokenizer.from_str(content)
            tokenizer.encode_special_tokens = True
            self.encode_one = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encode_one(f" {t}") for t in texts]


class Pieces:
    """A piece tokenizer with byte fallback from its model file; ``tokens`` are the bytes of each id."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = [self._bytes(i) for i in range(self.processor.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.processor.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.processor.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


def endings(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted ``a << 32 | b`` of all ids of which one's bytes end with the other's: no other pair is ever linked."""
    if not all(a) or not all(b):
        raise ValueError("a token without bytes cannot be aligned")

    def by_bytes(tokens):
        ids: dict[bytes, list[int]] = {}
        for i, token in enumerate(tokens):
            ids.setdefault(token, []).append(i)
        return ids
    of_a, of_b = by_bytes(a), by_bytes(b)
    found = [x << 32 | y for x, token in enumerate(a) for i in range(len(token)) for y in of_b.get(token[i:], ())]
    found += [x << 32 | y for y, token in enumerate(b) for i in range(1, len(token)) for x in of_a.get(token[i:], ())]
    return np.unique(np.array(found, np.int64))


class Side:
    """Tokens of a batch on one side: flat ids, the document of each, the byte offset in it where each ends."""

    def __init__(self, tokens: pa.Array, lengths: pa.Array, ids: list[list[int]]):
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, sum(map(len, ids)))
        offsets = np.append(0, np.cumsum([len(i) for i in ids])).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        self.ids, self.doc = pc.list_flatten(listed), pc.list_parent_indices(listed)
        self.offsets = offsets
        upto = np.append(0, pc.cumulative_sum(lengths.take(self.ids)).to_numpy())
        starts = pa.array(upto[offsets[:-1]])
        self.end = pc.subtract(pa.array(upto[1:]), starts.take(self.doc))
        self.pieces = tokens.take(self.ids)
        self.bytes_at = upto[offsets]

    def key(self) -> pa.Array:
        """Document and end of each token as one number; a text is far below 2^32 bytes."""
        return pc.bit_wise_or(pc.shift_left(self.doc.cast(pa.int64()), 32), self.end)

    def bytes_of(self) -> list[bytes]:
        """The joined token bytes of each document."""
        joined = self.pieces.buffers()[2].to_pybytes() if len(self.pieces) else b""
        return [joined[x:y] for x, y in zip(self.bytes_at[:-1].tolist(), self.bytes_at[1:].tolist())]


class Aligner:
    """Both tokenizers and the sorted id pairs that may be linked."""

    def __init__(self, a: ByteLevel, b: Pieces, pairs: np.ndarray):
        self.a, self.b, self.pairs = a, b, pairs
        self.tokens = [pa.array(t.tokens, pa.binary()) for t in (a, b)]
        self.lengths = [pc.binary_length(t).cast(pa.int64()) for t in self.tokens]
        names = [np.char.mod("%d", np.arange(len(t.tokens))).tolist() for t in (a, b)]
        # an id followed by what stands after it: inside a group, and at the end of its side
        self.names = pa.array([n + mark for side, marks in zip(names, (",|", ",;")) for mark in marks for n in side])

    def sides(self, texts: list[str]) -> tuple[Side, Side]:
        wanted = [f" {t}".encode() for t in texts]
        ids = [self.a.encode(texts), self.b.encode(texts)]
        ids = [[i if t else [] for i, t in zip(side, texts)] for side in ids]
        made = [Side(t, n, i) for t, n, i in zip(self.tokens, self.lengths, ids)]
        right = [x == y == w for x, y, w in zip(made[0].bytes_of(), made[1].bytes_of(), wanted)]
        if all(right):
            return made[0], made[1]
        kept = [[i if r else [] for i, r in zip(side, right)] for side in ids]
        return tuple(Side(t, n, i) for t, n, i in zip(self.tokens, self.lengths, kept))

    def links(self, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
        """Places in the batch (i of A, j of B) of all tokens that end together, in order."""
        left, right = (pa.table({"key": s.key(), place: pa.array(np.arange(len(s.ids), dtype=np.int32))}) for s, place in ((a, "i"), (b, "j")))
        joined = left.join(right, "key", join_type="inner", use_threads=False)
        i, j = joined["i"].to_numpy(), joined["j"].to_numpy()
        order = np.lexsort((j, i))
        return i[order], j[order]

    def grouped(self, a: Side, b: Side, links: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each document: the tokens between two common ends, A's before B's."""
        last = [np.zeros(len(s.ids), bool) for s in (a, b)]
        for mark, places in zip(last, links):
            mark[places] = True
        group = [np.cumsum(x) - x for x in last]
        n = int(last[0].sum())
        sizes = [np.bincount(g, minlength=n)[:n] for g in group]
        before = [np.cumsum(s) for s in sizes]
        at_a = np.arange(len(group[0])) + (before[1] - sizes[1])[group[0]]
        at_b = np.arange(len(group[1])) + before[0][group[1]]
        names = np.empty(len(at_a) + len(at_b), np.int64)
        n_a, n_b = len(self.a.tokens), len(self.b.tokens)
        names[at_a] = a.ids.to_numpy() + np.where(last[0], n_a, 0)
        names[at_b] = b.ids.to_numpy() + np.where(last[1], n_b, 0) + 2 * n_a
        ends = (a.offsets + b.offsets).tolist()
        line = self.names.take(pa.array(names))
        text = line.buffers()[2].to_pybytes() if len(line) else b""
        at = np.frombuffer(line.buffers()[1], np.int32)[ends].tolist() if len(line) else [0] * len(ends)
        return [text[x:max(x, y - 1)] for x, y in zip(at[:-1], at[1:])]

    def rows(self, doc_ids: pa.Array, texts: list[str], digest: bool) -> pa.RecordBatch:
        a, b = self.sides(texts)
        i, j = found = self.links(a, b)
        n = len(texts)
        doc, ends = a.doc.to_numpy()[i], a.end.to_numpy()[i]
        linked = np.bincount(doc, minlength=n)
        new = np.append(True, (doc[1:] != doc[:-1]) | (ends[1:] != ends[:-1]))[:len(doc)]
        number = np.searchsorted(self.pairs, a.ids.to_numpy()[i].astype(np.int64) << 32 | b.ids.to_numpy()[j]).astype(np.int32)
        groups = self.grouped(a, b, found)
        shown = [hashlib.sha256(g).hexdigest() if g and digest else g.decode() for g in groups]
        offsets = pa.array(np.append(0, np.cumsum(linked)).astype(np.int32))
        return pa.RecordBatch.from_arrays([
            doc_ids, pa.array(np.diff(a.offsets), pa.int64()), pa.array(np.diff(b.offsets), pa.int64()), pa.array(np.bincount(doc[new], minlength=n), pa.int64()),
            pa.array(linked, pa.int64()), pa.array(shown, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(number)),
        ], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])


@functools.lru_cache(maxsize=1)
def worker_aligner(left: str, right: bytes, pairs: bytes) -> Aligner:
    """Made once per worker process."""
    return Aligner(ByteLevel(left), Pieces(right), np.frombuffer(pairs, np.int64))


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_CHARS`` characters, one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > CHUNK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = pa.table({"pair": pc.list_flatten(batch.column("links"))})
        counted = links.group_by("pair").aggregate([([], "count_all")])
        yield from counted.select(["pair", "count_all"]).rename_columns(["pair", "n"]).combine_chunks().to_batches()


class Alignment:
    """Two tokenizers, by the paths of their files, applied to documents (doc_id, text)."""

    def __init__(self, left: str, right: str):
        with open(left, encoding="utf-8") as a, open(right, "rb") as b:
            self.files = a.read(), b.read()
        self.pairs = endings(ByteLevel(self.files[0]).tokens, Pieces(self.files[1]).tokens)

    def rows(self, docs: DataFrame, digest: bool = False) -> DataFrame:
        """Per document its tokens' numbers, ``groups`` as text (or its SHA-256, empty for none) and its ``links``, numbers of pairs."""
        spark = docs.sparkSession
        small_batches(spark)
        shared = spark.sparkContext.broadcast((*self.files, self.pairs.tobytes()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = worker_aligner(*shared.value)
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for x, y in chunks(texts):
                    yield aligner.rows(batch.column("doc_id").slice(x, y - x), texts[x:y], digest)
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ROWS)

    def counts(self, rows: DataFrame) -> DataFrame:
        """(pair, n): how many links of all rows hold each id pair; at most as many rows as the vocabularies have pairs."""
        return rows.select("links").mapInArrow(_pair_counts, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))

    def named(self, counts: DataFrame) -> DataFrame:
        """(a, b, n): the counts by token ids."""
        spark = counts.sparkSession
        table = pa.table({"pair": pa.array(np.arange(len(self.pairs)), pa.int32()), "a": pa.array(self.pairs >> 32, pa.int32()), "b": pa.array(self.pairs & 0xFFFFFFFF, pa.int32())})
        return counts.join(F.broadcast(spark.createDataFrame(table)), "pair").select("a", "b", "n")

    def scored(self, rows: DataFrame, counts: DataFrame) -> DataFrame:
        """The rows with ``n_best``, how many links have the highest count of their B id, and ``count_sum``, instead of ``links``."""
        known = counts.toArrow()
        n = np.zeros(len(self.pairs), np.int64)
        n[known["pair"].to_numpy()] = known["n"].to_numpy()
        b = self.pairs & 0xFFFFFFFF
        highest = np.zeros(int(b.max()) + 1, np.int64)
        np.maximum.at(highest, b, n)
        shared = rows.sparkSession.sparkContext.broadcast((n, n == highest[b]))
        kept = [c for c in rows.columns if c != "links"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts_of, best_of = (pa.array(x.astype(np.int64)) for x in shared.value)
            for batch in batches:
                links = batch.column("links")
                pair, doc = pc.list_flatten(links), pc.list_parent_indices(links)
                sums = pa.table({"doc": doc, "n": counts_of.take(pair), "best": best_of.take(pair)}).group_by("doc").aggregate([("n", "sum"), ("best", "sum")])
                out = np.zeros((2, batch.num_rows), np.int64)
                out[:, sums["doc"].to_numpy()] = sums["best_sum"].to_numpy(), sums["n_sum"].to_numpy()
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, out)], names=[*kept, "n_best", "count_sum"])
        schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "links")
        return rows.mapInArrow(run, f"{schema}, n_best long, count_sum long")


def align(docs: DataFrame, left: str, right: str, digest: bool = False) -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum."""
    alignment = Alignment(left, right)
    rows = stored(alignment.rows(docs, digest), "aligned")
    return alignment.scored(rows, alignment.counts(rows))
