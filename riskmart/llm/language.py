"""Language identification: known words first, shorter and shorter character n-grams for the others.

A word is a run of letters, lower-cased. The model holds, per language, the smoothed log frequency of each known word and of each character
n-gram of lengths 4 to 1 (words are framed by spaces for that). A word's score is that of the longest thing known about it: the word itself, else
the mean over its known n-grams of the greatest length that has any, less ``BACKOFF`` for each length gone down. A text's score is the sum over its words; its
probability compares the languages after dividing by the square root of the number of words, since words of one text are not independent.

The model is learned from at most ``sample_rows`` rows of each language, those with the smallest hash of their id; it keeps the ``MAX_WORDS`` most
frequent words and ``MAX_GRAMS`` n-grams of each length, so its size is bounded. Words beyond are what the backoff is for.

A text that is null or has no letter is ``und`` with score 0. Without a single labelled row every text is ``und``.
Equal scores go to the language whose name sorts first. A labelled language without any letters in its sample is not learned.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import TEST_FOLD, fold, picked, small_batches, stored

SAMPLE_ROWS = 2000
MAX_WORDS = 60_000
MAX_GRAMS = 20_000
LENGTHS = (4, 3, 2, 1)
BACKOFF = 1.0
SMOOTHING = 0.5
MEMO_WORDS = 100_000
UNKNOWN = "und"
RESULT = "struct<lang_pred:string,score:double,met:double>"
#: An n-gram of this length or longer tells that a word may belong to a learned language.
TELLING = 3
LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def grams_of(word: str, length: int) -> list[str]:
    framed = f" {word} " if length > 1 else word
    return [framed[i:i + length] for i in range(len(framed) - length + 1)]


@dataclass
class Model:
    """Log frequencies by language: one row per word or n-gram, one column per language."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: dict[int, dict[str, np.ndarray]]

    def __getstate__(self) -> tuple:
        """Written as one matrix per table: a broadcast of many small arrays is several times larger."""
        packed = {k: (list(t), np.array(list(t.values())).reshape(len(t), len(self.languages))) for k, t in {0: self.words, **self.grams}.items()}
        return self.languages, packed

    def __setstate__(self, state: tuple) -> None:
        self.languages, packed = state
        tables = {k: dict(zip(units, rows)) for k, (units, rows) in packed.items()}
        self.words, self.grams = tables.pop(0), tables

    def score_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        for down, length in enumerate(LENGTHS, 1):
            table = self.grams[length]
            found = [table[g] for g in grams_of(word, length) if g in table]
            if found:
                return np.mean(found, axis=0) - BACKOFF * down
        return np.zeros(len(self.languages))


class Scorer:
    """Scores texts; remembers the scores of the words it has met in the rows of a table, up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        width = len(model.languages)
        self.places: dict[int, dict[str, int]] = {}
        self.grams: dict[int, np.ndarray] = {}
        for length in LENGTHS:
            table = model.grams.get(length, {})
            self.places[length] = dict(zip(table, range(len(table))))
            self.grams[length] = np.array(list(table.values()), np.float32).reshape(len(table), width)
        self.memo: dict[str, int] = {}
        # the last column tells whether the word, or a long n-gram of it, was met in learning
        self.known = np.zeros((0, width + 1), np.float32)

    def _backed_off(self, words: list[str], out: np.ndarray) -> None:
        """``Model.score_word`` of unknown words, one n-gram length after the other."""
        left = range(len(words))
        for down, length in enumerate(LENGTHS, 1):
            places = self.places[length]
            at, ends, who, rest = [], [], [], []
            for i in left:
                found = [p for g in grams_of(words[i], length) if (p := places.get(g)) is not None]
                if found:
                    ends.append(len(at))
                    who.append(i)
                    at += found
                else:
                    rest.append(i)
            if who:
                sums = np.add.reduceat(self.grams[length][at], ends, axis=0)
                out[who, :-1] = sums / np.diff([*ends, len(at)])[:, None] - BACKOFF * down
                out[who, -1] = length >= TELLING
            left = rest

    def _rows(self, counts: Counter) -> np.ndarray:
        """One row of scores per distinct word, in the order of ``counts``."""
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.known = {}, self.known[:0]
        memo, words = self.memo, self.model.words
        new = [w for w in counts if w not in memo]
        if new:
            start = len(memo)
            if start + len(new) > len(self.known):
                grown = np.zeros((max(2 * len(self.known), start + len(new), 1024), self.known.shape[1]), np.float32)
                grown[:start] = self.known[:start]
                self.known = grown
            here = np.zeros((len(new), self.known.shape[1]), np.float32)
            met = [i for i, w in enumerate(new) if w in words]
            if met:
                here[met, :-1] = [words[new[i]] for i in met]
                here[met, -1] = 1
            unknown = [i for i, w in enumerate(new) if w not in words]
            scores = np.zeros((len(unknown), here.shape[1]), np.float32)
            self._backed_off([new[i] for i in unknown], scores)
            here[unknown] = scores
            self.known[start:start + len(new)] = here
            memo.update(zip(new, range(start, start + len(new))))
        return self.known[np.fromiter(map(memo.__getitem__, counts), np.int64, len(counts))]

    def __call__(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, its score, and the share of words that learning has met, whole or in a long n-gram."""
        counts = Counter(words_of(text))
        languages = self.model.languages
        if not counts or not languages:
            return UNKNOWN, 0.0, 0.0
        rows = self._rows(counts)
        times = np.fromiter(counts.values(), np.float64, len(counts))
        sums = times @ rows
        total = sums[:-1] / math.sqrt(times.sum())
        chances = np.exp(total - total.max())
        best = int(np.argmax(total))
        return languages[best], float(chances[best] / chances.sum()), float(sums[-1] / times.sum())


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: labelled, and outside the held-out fold."""
    kept = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(fold(), F.lit(TEST_FOLD)) != TEST_FOLD))
    return kept.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """(lang, text) of at most ``rows`` ids of each language, those with the smallest hash.

    Ids are picked on their own, so texts are moved for the sample only; a repeated id counts once, with its smallest text.
    """
    known = learnable(docs)
    ids = picked(known.select("lang", "doc_id").distinct(), "lang", rows).drop("total")
    return known.join(F.broadcast(ids), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text")).drop("doc_id")


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts per batch of each (language, kind, unit); kind 0 is the word, else the n-gram's length."""
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            words.setdefault(lang, Counter()).update(words_of(text))
        for lang, seen in words.items():
            for length in (0, *LENGTHS):
                counts = seen
                if length:
                    counts = Counter()
                    for word, n in seen.items():
                        for gram in grams_of(word, length):
                            counts[gram] += n
                yield pd.DataFrame({"lang": lang, "kind": length, "unit": list(counts), "n": list(counts.values())})


def _counts(top: pa.Table, languages: list[str]) -> np.ndarray:
    """One row of counts per unit, one column per language."""
    lang, n = top["lang"].combine_chunks(), top["n"].combine_chunks()
    out = np.zeros((len(top), len(languages)))
    at = pc.index_in(pc.list_flatten(lang), value_set=pa.array(languages, pa.string()))
    out[pc.list_parent_indices(lang).to_numpy(zero_copy_only=False), at.to_numpy(zero_copy_only=False)] = pc.list_flatten(n).to_numpy(zero_copy_only=False)
    return out


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample; what reaches the driver is bounded by the kept words and n-grams."""
    small_batches(docs.sparkSession)
    units = sample(docs, sample_rows).mapInPandas(_units, "lang string, kind int, unit string, n long")
    counted = stored(units.groupBy("kind", "unit", "lang").agg(F.sum("n").alias("n")), "units")
    by_unit = counted.groupBy("kind", "unit").agg(F.collect_list(F.struct("lang", "n")).alias("by"), F.sum("n").alias("all"))
    totals: dict[tuple[int, str], int] = {(r["kind"], r["lang"]): r["n"] for r in counted.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted({lang for _, lang in totals})
    tables: dict[int, dict[str, np.ndarray]] = {}
    for kind in (0, *LENGTHS):
        most = MAX_WORDS if kind == 0 else MAX_GRAMS
        # as Arrow: the tasks merge their firsts, where collect() would have the driver take those of every task as objects
        top = by_unit.where(F.col("kind") == kind).orderBy(F.desc("all"), "unit").limit(most).select("unit", "by.lang", "by.n").toArrow()
        under = np.array([totals.get((kind, lang), 0) + SMOOTHING * max(1, len(top)) for lang in languages])
        logs = np.log((_counts(top, languages) + SMOOTHING) / under).astype(np.float32)
        tables[kind] = dict(zip(top["unit"].to_pylist(), logs))
    return Model(languages, tables.pop(0), tables)


def predicted(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """Struct column (lang_pred, score, met) for a text column of the frame."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame([scorer.judge(t) for t in texts], columns=["lang_pred", "score", "met"])
    return judge(F.col(text).cast("string"))


def identify(docs: DataFrame, model: Model | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    found = predicted(model or learn(docs, sample_rows), docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold() == TEST_FOLD, F.lit(False)).alias("held_out"), found.alias("found"))
    return rows.select("doc_id", "held_out", "found.lang_pred", "found.score")
