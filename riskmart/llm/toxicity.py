"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

The lexicon holds words, and starts of words of four and five letters, that labelled toxic texts use far more often than others (``MIN_G`` on the
log-likelihood ratio and ``MIN_LOG_ODDS``). Uses are counted once per pair of neighbouring words, so copies of one text do not make its rare words look
toxic. Features: densities and counts of lexicon hits, hits close to a second-person word, rates of capitals, punctuation and marks inside words,
hits that only show after such marks are undone, number and mean length of words.

Trees (Spark ML) learn from three quarters of at most ``sample_rows`` labelled rows per label, those with the smallest hash of their id and outside the held-out fold;
isotonic regression on the rest maps their probability to the share of toxic rows. Rows are weighted back to the true share of each label. With
no labelled row, or one label only, the score is that share for every text. Null texts count as empty; they are scored like any other.
"""

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import TEST_FOLD, fold, free_name, picked, small_batches, stored

SAMPLE_ROWS = 4000
MIN_G = 30.0
MIN_LOG_ODDS = 2.5
MAX_ENTRIES = 5000
STARTS = (4, 5)
NEAR = 5
THRESHOLD = 0.7
MEMO_WORDS = 100_000
USES_HELD = 100_000
TREES, DEPTH = 20, 4
CALIBRATION_SHARE = 4

# Second-person words, and the letters that signs stand for.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer tú ti tus usted ustedes vosotros".split()
)
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

FEATURES = (
    "hit_density", "hits", "start_density", "starts", "distinct", "near_second_person", "capitals", "shouted", "punctuation", "exclaimed",
    "marked", "undone_hits", "words", "word_length",
)
EDGE = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")
CLOSING = ".,;:!?)\"'"
TOKEN_FACTS = 10
INNER = regex.compile(r"[^\p{L}]+")
MARKED = regex.compile(r"\p{L}[^\p{L}\s'’-]+\p{L}")


def plain(token: str) -> str:
    return EDGE.sub("", token).lower()


def undone(token: str) -> str:
    """The letters a token stands for when signs replace or separate them."""
    return INNER.sub("", token.lower().translate(SIGNS))


@dataclass
class Lexicon:
    words: frozenset = frozenset()
    starts: frozenset = frozenset()


class Features:
    """Dense features of texts; what is known of a token is remembered in the rows of a table, up to a bound."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.memo: dict[str, int] = {}
        self.known = np.zeros((0, TOKEN_FACTS), np.float32)

    def look(self, token: str) -> tuple:
        """(hit, start, undone hit, letters, capitals, shouted, punctuation, exclaimed, marked, second person)"""
        lexicon = self.lexicon
        bare = token.rstrip(CLOSING)
        word = bare.lower()
        if bare.isalpha() and word.isalpha():  # letters and closing signs only: no edge to cut, nothing marked
            hidden = marked = False
            letters, signs = len(bare), len(token) - len(bare)
            capitals = 0 if bare.islower() else sum(map(str.isupper, bare))
        else:
            word = plain(token)
            marked = MARKED.search(token) is not None or (word != "" and not word.isalpha() and any(c.isalpha() for c in word))
            meant = undone(token) if marked else ""
            hidden = marked and word not in lexicon.words and (meant in lexicon.words or self._starts(meant))
            letters = sum(c.isalpha() for c in token)
            capitals = sum(c.isupper() for c in token)
            signs = sum(not c.isalnum() for c in token)
        exclaimed = token.count("!") + token.count("?") if signs else 0
        shouted = letters > 1 and capitals == letters
        return word in lexicon.words, self._starts(word), hidden, letters, capitals, shouted, signs, exclaimed, marked, word in SECOND_PERSON

    def _starts(self, word: str) -> bool:
        starts = self.lexicon.starts
        return any(word[:n] in starts for n in STARTS if len(word) > n)

    def _rows(self, counts: Counter) -> np.ndarray:
        """One row of facts per distinct token, in the order of ``counts``."""
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.known = {}, self.known[:0]
        memo = self.memo
        new = [t for t in counts if t not in memo]
        if new:
            start = len(memo)
            if start + len(new) > len(self.known):
                grown = np.zeros((max(2 * len(self.known), start + len(new), 1024), TOKEN_FACTS), np.float32)
                grown[:start] = self.known[:start]
                self.known = grown
            self.known[start:start + len(new)] = list(map(self.look, new))
            memo.update(zip(new, range(start, start + len(new))))
        return self.known[np.fromiter(map(memo.__getitem__, counts), np.int64, len(counts))].astype(np.float64)

    def __call__(self, text: str | None) -> list[float]:
        tokens = (text or "").split()
        if not tokens:
            return [0.0] * len(FEATURES)
        counts = Counter(tokens)
        table = self._rows(counts)
        times = np.fromiter(counts.values(), np.float64, len(counts))
        hit, start, hidden, letters, capitals, shouted, signs, exclaimed, marked, second = times @ table
        n, chars = len(tokens), max(1.0, letters + signs)
        met = table[:, :3].any(axis=1)
        near = self._near(tokens, *(set(itertools.compress(counts, mask.tolist())) for mask in (met, table[:, 9] > 0))) if second and met.any() else 0.0
        return [
            hit / n, math.log1p(hit), start / n, math.log1p(start), math.log1p(float(met.sum())), near, capitals / max(1.0, letters), shouted / n, signs / chars,
            exclaimed / n, marked / n, math.log1p(hidden), math.log1p(n), letters / n,
        ]

    @staticmethod
    def _near(tokens: list[str], met: set[str], second: set[str]) -> float:
        """Share of hits with a second-person word among their neighbours."""
        hits = [i for i, t in enumerate(tokens) if t in met]
        return sum(not second.isdisjoint(tokens[max(0, i - NEAR):i + NEAR + 1]) for i in hits) / len(hits)


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows of each label as (doc_id, text, toxic, weight), outside the held-out fold.

    A doc_id with several labels counts as toxic if one of them says so; a repeated document counts once, with its smallest text.
    """
    marked = labels.where(F.col("toxic").isin(0, 1) & (F.coalesce(fold(), F.lit(TEST_FOLD)) != TEST_FOLD)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = picked(marked, "toxic", rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    once = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic", "total").agg(F.min("text").alias("text"))
    return once.select(
        "doc_id", "text", F.col("toxic").cast("double").alias("toxic"), (F.col("total") / F.least("total", F.lit(rows))).alias("weight"),
    )


def _uses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(kind, unit, neighbours, toxic) of every word; kind 0 is the word, else the length of its start."""
    columns = ["kind", "unit", "near", "toxic"]
    for batch in batches:
        seen: set = set()
        for text, toxic in zip(batch["text"], batch["toxic"]):
            words = [w for w in map(plain, (text or "").split()) if w]
            for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                near = f"{before} {after}"
                seen.add((0, word, near, toxic))
                for n in STARTS:
                    if len(word) > n:
                        seen.add((n, word[:n], near, toxic))
            if len(seen) > USES_HELD:
                yield pd.DataFrame(list(seen), columns=columns)
                seen = set()
        yield pd.DataFrame(list(seen), columns=columns)


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words and starts tied to the toxic label; at most ``MAX_ENTRIES`` reach the driver."""
    uses = rows.mapInPandas(_uses, "kind int, unit string, near string, toxic double")
    once = uses.groupBy("kind", "unit", F.xxhash64("near").alias("near")).agg(F.max("toxic").alias("toxic"))
    by = stored(once.groupBy("kind", "unit").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "lexicon")
    totals = by.groupBy("kind").agg(F.sum("t").alias("tt"), F.sum("c").alias("cc"))
    n = F.col("t") + F.col("c")
    rate = F.col("tt") / (F.col("tt") + F.col("cc"))
    share = F.col("t") / n
    rest = F.when(F.col("c") > 0, F.col("c") * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    scored = by.where("t >= 3").join(F.broadcast(totals), "kind").withColumn("g", 2 * (F.col("t") * F.log(share / rate) + rest)).withColumn(
        "odds", F.log((F.col("t") + 0.5) / (F.col("tt") + 1)) - F.log((F.col("c") + 0.5) / (F.col("cc") + 1)))
    kept = scored.where((F.col("g") >= MIN_G) & (F.col("odds") >= MIN_LOG_ODDS)).orderBy(F.desc("g"), "kind", "unit").limit(MAX_ENTRIES)
    found = [(r["kind"], r["unit"]) for r in kept.select("kind", "unit").collect()]
    return Lexicon(frozenset(u for k, u in found if k == 0), frozenset(u for k, u in found if k))


def features(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Features(shared.value)
        for texts in batches:
            yield pd.Series([of(t) for t in texts], dtype=object)
    return measure(F.col(text).cast("string"))


@dataclass
class Model:
    lexicon: Lexicon = field(default_factory=Lexicon)
    prior: float = 0.0
    trees: GBTClassificationModel | None = None
    steps: IsotonicRegressionModel | None = None


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    rows = stored(sample(docs, labels, sample_rows), "labelled")
    shares = {r["toxic"]: (r["n"], r["w"]) for r in rows.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    everything = sum(w for _, w in shares.values())
    prior = shares.get(1.0, (0, 0.0))[1] / everything if everything else 0.0
    if len(shares) < 2:
        return Model(prior=prior)
    lexicon = learn_lexicon(rows)
    held = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATION_SHARE)) == 0
    measured = stored(rows.withColumn("f", array_to_vector(features(rows, lexicon))).withColumn("held", held).select("f", "toxic", "weight", "held").coalesce(4), "measured")
    split = {(r["held"], r["toxic"]) for r in measured.groupBy("held", "toxic").count().collect()}
    fitted, checked = (measured.where(~F.col("held")), measured.where("held")) if len(split) == 4 else (measured, measured)
    trees = GBTClassifier(featuresCol="f", labelCol="toxic", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, minInstancesPerNode=2).fit(fitted)
    chance = vector_to_array("probability")[1]
    judged = trees.transform(checked).select(chance.alias("chance"), "toxic", "weight")
    steps = IsotonicRegression(featuresCol="chance", labelCol="toxic", weightCol="weight").fit(judged)
    return Model(lexicon, prior, trees, steps)


def scored(docs: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    """The frame with the score as an added column ``out``; other columns keep their names and values."""
    if model.trees is None:
        return docs.withColumn(out, F.lit(model.prior))
    names = docs.columns
    cols = [free_name(docs, f"_tox_{c}") for c in ("f", "raw", "prob", "label", "chance", "score")]
    f, raw, prob, label, chance, score = cols
    trees = model.trees.copy().setFeaturesCol(f).setRawPredictionCol(raw).setProbabilityCol(prob).setPredictionCol(label)
    steps = model.steps.copy().setFeaturesCol(chance).setPredictionCol(score)
    found = trees.transform(docs.withColumn(f, array_to_vector(features(docs, model.lexicon, text)))).withColumn(chance, vector_to_array(prob)[1])
    value = F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(1.0))
    return steps.transform(found).select(*[F.col(f"`{c}`") for c in names], value.alias(out))


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done = scored(rows, learn(docs, labels, sample_rows), "score")
    return done.select(
        "doc_id", F.coalesce(fold() == TEST_FOLD, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
