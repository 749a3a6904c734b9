"""Corpus preparation in four stages: toxicity, language identification, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read back before the next. All but the last return the columns
of documents as they came, extra ones included. Learning uses what its predecessors kept and, for toxicity, the table labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import language, neardup, packing, toxicity
from riskmart.llm.shared import free_name, stored, table

#: Share of words met in learning, whole or in an n-gram of three letters or more; it does not depend on the number of languages.
LEAST_MET = 0.5


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return toxicity.scored(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).select(*_columns(docs))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words at least half were met in the learned languages; those without a letter go.

    Where no document says what language it is in, all with a letter stay.
    """
    model = language.learn(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = free_name(docs, "_found")
    judged = docs.withColumn(found, language.predicted(model, docs))
    sure = (F.col(f"{found}.lang_pred") != language.UNKNOWN) & (F.col(f"{found}.met") >= LEAST_MET)
    return judged.where(sure).select(*_columns(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Rows equal in id and text are one document, of which the first by its columns written as JSON stays. Different texts under one id are documents of
    their own, ordered by id and digest of the text. Rows without an id cannot be told apart by one and stay.
    """
    known = docs.where("doc_id is not null")
    if known.groupBy("doc_id").count().where("count > 1").isEmpty():
        return _single(docs, "doc_id").select(*_columns(docs))
    number, digest = free_name(docs, "_number"), free_name(docs, "_digest")
    rows = known.withColumn(digest, F.coalesce(F.sha2(F.col("text").cast("string").cast("binary"), 256), F.lit("")))
    # numbers of a sorted table rise with its order, so the smallest number of a group has its smallest id
    numbers = stored(rows.select("doc_id", digest).distinct().orderBy("doc_id", digest).withColumn(number, F.monotonically_increasing_id()), "numbers")
    left = _single(rows.join(numbers, ["doc_id", digest]), number)
    row = F.struct(*_columns(docs))
    once = left.groupBy(number).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return once.unionByName(docs.where("doc_id is null"))


def _single(docs: DataFrame, number: str) -> DataFrame:
    """Rows but those of documents, told apart by ``number``, that are near-duplicates of one with a smaller number."""
    judged = neardup.deduplicate(docs.select(F.col(number).alias("doc_id"), "text"), neardup.Rule())
    gone = stored(judged.where("doc_id is not null and not kept").select(F.col("doc_id").alias(number)).distinct(), "gone")
    return docs.join(gone, number, "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of pieces of the documents, by length bucket."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: Learned models decide the first two stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
