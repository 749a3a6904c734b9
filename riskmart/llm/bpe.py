"""Byte-level BPE: merges replayed over all distinct words of a batch at once, then exact decoding.

Texts are cut into words by the tokenizer's pattern. The distinct words that a task has not met before are laid end to end, one symbol per
byte, and an inverted index maps the rank of each pair of neighbouring symbols to the positions where it stands. Ranks are taken in rising
order; a merge looks at the listed positions only and enters the pairs that the new symbol forms with its two neighbours. A word
that is a token itself is that token. A merge whose token may form a pair of lower rank is applied to the first position of each word only before
ranks are looked at again, so each word sees the merges in the order in which it would see them alone: lowest rank first, leftmost first.

The first ``MEMO_WORDS`` words that a task meets are remembered, others are worked out again per batch, which changes no result. Ranks travel as a
broadcast whose size is that of the vocabulary file. A null text is empty and has no tokens.
"""

import base64
import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.shared import small_batches

MEMO_WORDS = 300_000
VOCABULARY_BYTES = 64 << 20
SHIFT = 24
NONE = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if sum(map(len, ranks)) > VOCABULARY_BYTES:
        raise ValueError(f"{path}: more token bytes than are broadcast")
    return ranks


class Merges:
    """What two neighbouring tokens merge to: sorted keys of token pairs, and the rank of each."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (left << SHIFT | right, rank) for token, rank in ranks.items() for i in range(1, len(token))
            if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None
        ]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.ranks = np.append(table[:, 0], np.int64(1) << 62), np.append(table[:, 1], NONE)
        self.bytes = np.array([ranks.get(bytes([i]), NONE) for i in range(256)], np.int64)
        left, right, rank = self.keys >> SHIFT, self.keys & ((1 << SHIFT) - 1), self.ranks
        #: tokens that may form a pair of lower rank than their own
        self.early = set(left[rank < left].tolist()) | set(right[(rank < right) & (rank < NONE)].tolist())

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where it has none."""
        key = left << SHIFT | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def _listed(index: dict, heap: list, ranks: np.ndarray, places: np.ndarray) -> None:
    """Enter positions under the ranks of the pairs that start there."""
    known = ranks < NONE
    ranks, places = ranks[known], places[known]
    order = np.argsort(ranks, kind="stable")
    ranks, places = ranks[order], places[order]
    cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
    for rank, part in zip(ranks[np.append(0, cuts)].tolist() if len(ranks) else [], np.split(places, cuts)):
        if rank in index:
            index[rank].append(part)
        else:
            index[rank] = [part]
            heapq.heappush(heap, rank)


def _apart(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Positions, leftmost first, without those whose first symbol an earlier one takes."""
    taken, kept = set(), []
    for i, j in zip(places.tolist(), after[places].tolist()):
        if i not in taken:
            kept.append(i)
            taken.add(j)
    return np.array(kept, np.int64)


def replay(words: list[bytes], ranks: dict[bytes, int], merges: Merges) -> list[list[int]]:
    """Token ids of each word by one replay of the merges over all of them."""
    whole = [ranks.get(w) for w in words]
    spelled = [w for w, rank in zip(words, whole) if rank is None]
    if not spelled:
        return [[rank] for rank in whole]
    sizes = np.array([len(w) for w in spelled])
    ends = np.cumsum(sizes)
    token = merges.bytes[np.frombuffer(b"".join(spelled), np.uint8)]
    n = len(token)
    word = np.repeat(np.arange(len(spelled)), sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1] = -1
    before[ends - sizes] = -1
    starts = np.flatnonzero(after >= 0)
    at = np.full(n, NONE, np.int64)
    at[starts] = merges.of(token[starts], token[starts + 1])
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    _listed(index, heap, at[starts], starts)
    while heap:
        rank = heapq.heappop(heap)
        places = np.concatenate(index.pop(rank))
        places = np.unique(places[at[places] == rank])
        if not len(places):
            continue
        if len(places) > 1 and (at[after[places]] == rank).any():
            places = _apart(places, after)
        if rank in merges.early and len(places) > 1:
            # a pair formed by the first merge of a word may come before the others
            first = np.append(True, word[places[1:]] != word[places[:-1]])
            if not first.all():
                _listed(index, heap, np.full((~first).sum(), rank), places[~first])
            places = places[first]
        gone = after[places]
        far, near = after[gone], before[places]
        token[places] = rank
        token[gone] = -1
        at[gone] = NONE
        after[places] = far
        right = far >= 0
        before[far[right]] = places[right]
        ranks_right = np.full(len(places), NONE, np.int64)
        ranks_right[right] = merges.of(token[places[right]], token[far[right]])
        at[places] = ranks_right
        left = near[near >= 0]
        at[left] = ranks_left = merges.of(token[left], token[after[left]])
        _listed(index, heap, np.concatenate([ranks_right, ranks_left]), np.concatenate([places, left]))
    rest = token >= 0
    pieces = iter(np.split(token[rest], np.cumsum(np.bincount(word[rest], minlength=len(spelled)))[:-1]))
    return [[rank] if rank is not None else next(pieces).tolist() for rank in whole]


class Coder:
    """Encodes and decodes texts; keeps what it knows of the first words met, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.merges = ranks, Merges(ranks)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.words_of = regex.compile(pattern).findall
        self.memo: dict[str, tuple] = {}

    def decode(self, ids) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def cut(self, texts: list[str]) -> tuple[list[list[str]], dict[str, tuple]]:
        """The words of each text, and for each distinct word its ids, their decimal digits, their number and their bytes."""
        words = [self.words_of(t) for t in texts]
        memo = self.memo
        new = [w for w in dict.fromkeys(itertools.chain.from_iterable(words)) if w not in memo]
        found = {}
        for word, ids in zip(new, replay([w.encode("utf-8", "replace") for w in new], self.ranks, self.merges)):
            found[word] = ids, " ".join(map(str, ids)), len(ids), self.decode(ids)
        if len(memo) + len(found) <= MEMO_WORDS:
            memo.update(found)
            return words, memo
        for word in itertools.chain.from_iterable(words):
            if word not in found:
                found[word] = memo[word]
        return words, found

    def encode(self, texts: list[str]) -> list[list[int]]:
        words, known = self.cut(texts)
        return [[i for w in own for i in known[w][0]] for own in words]


def _spread(spark: SparkSession, ranks: dict[bytes, int], pattern: str):
    shared = spark.sparkContext.broadcast((ranks, pattern))
    small_batches(spark)
    return lambda: Coder(*shared.value)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """The frame with the token ids of ``text`` as an added (or replaced) array column."""
    start = _spread(docs.sparkSession, ranks, pattern)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = start()
        for texts in batches:
            yield pd.Series(coder.encode([t or "" for t in texts]), dtype=object)
    return docs.withColumn(out, ids(F.col(text).cast("string")))


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per document the number of tokens, a digest of the ids, and one of the bytes that decoding the ids gives."""
    start = _spread(docs.sparkSession, ranks, pattern)

    def run(batches):
        coder = start()
        for batch in batches:
            words, known = coder.cut([t or "" for t in batch.column("text").to_pylist()])
            numbers, ids, back = [], [], []
            for own in words:
                met = [known[w] for w in own]
                numbers.append(sum([m[2] for m in met]))
                ids.append(hashlib.sha256(" ".join([m[1] for m in met]).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join([m[3] for m in met])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(numbers, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
