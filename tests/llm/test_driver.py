"""What corpus operators gather on the driver."""

import pickle

import numpy as np
import pytest

from riskmart.llm import language, neardup

SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture
def taken(spark, monkeypatch):
    """Rows that each collect() brought to the driver as objects; toPandas() without Arrow goes through it too."""
    kind, seen = type(spark.range(0)), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: seen.append(rows := collect(self)) or rows)
    return seen


def words(start, n):
    return " ".join("".join(chr(97 + (i // 26**k) % 26) for k in range(4)) for i in range(start, start + n))


def test_language_tables_reach_the_driver_as_arrow(spark, taken):
    docs = spark.createDataFrame([(i, words(40 * i, 80), "ab"[i % 2]) for i in range(60)] + [(99, "one", None), (None, None, "a")], SCHEMA)
    model = language.learn(docs)
    assert len(model.words) > 1000 and model.languages == ["a", "b"]
    assert sum(map(len, taken)) <= 20
    met = [(lang, w) for i, text, lang in docs.where("lang is not null and text is not null").where(language.fold() != language.TEST_FOLD).collect() for w in text.split()]
    sums = {lang: sum(x == lang for x, _ in met) for lang in "ab"}
    for word in list(model.words)[::97]:
        want = [np.log((met.count((lang, word)) + language.SMOOTHING) / (sums[lang] + language.SMOOTHING * len(model.words))) for lang in "ab"]
        assert model.words[word] == pytest.approx(want, rel=1e-6)


def test_language_model_without_rows(spark):
    model = language.learn(spark.createDataFrame([(1, "one", None), (2, None, "a")], SCHEMA))
    assert model.languages == [] and not model.words and not any(model.grams.values())
    assert pickle.loads(pickle.dumps(model)).grams == model.grams


def test_language_model_is_small_when_sent():
    rows = np.arange(40_000, dtype=np.float32).reshape(-1, 4)
    model = language.Model(list("abcd"), {f"w{i}": r for i, r in enumerate(rows)}, {n: {"g" * n: rows[n]} for n in language.LENGTHS})
    sent = pickle.dumps(model)
    assert len(sent) < 40 * len(rows)
    back = pickle.loads(sent)
    assert list(back.words) == list(model.words) and all((back.words[w] == model.words[w]).all() for w in model.words)
    assert back.languages == model.languages and {n: list(t) for n, t in back.grams.items()} == {n: list(t) for n, t in model.grams.items()}


def test_common_values_reach_the_driver_as_arrow(spark, taken):
    docs = spark.createDataFrame([(i, f"{words(0, 200)} {words(2000 + i, 1)}", None) for i in range(30)], SCHEMA)
    _, reps = neardup.classes(docs, neardup.Rule())
    edges = neardup.candidate_edges(reps, neardup.Rule())
    assert not taken
    assert {x for row in edges.collect() for x in row} == set(range(30))
