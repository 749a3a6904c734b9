"""Corpus operators on texts against brute force, and on odd input."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from riskmart.llm import bpe, fingerprint, language, neardup, packing, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (5, None, None, None, None), (4, "", "en", "s", 0), (3, "  \n\t ", "en", "s", 5), (2, "one", "en", "s", 3), (1, "a b", "en", "s", 3),
    (7, "word " * 30_000, "en", "s", 150_000), (8, "word " * 30_000, "en", "s", 150_000), (9, "x" * 20_000, "en", "s", 20_000),
    (10, "ÄÖ ß 日本語 😀\nline two", "de", "s", 20), (10, "ÄÖ ß 日本語 😀\nline two", "de", "s", 20), (None, "lost and found again today", "en", None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def clashing(docs):
    """Extra columns with names that the operators use themselves."""
    return docs.withColumns({c: F.lit("x") for c in ("rep", "mark", "sig", "score", "key", "at", "ghost", "bucket", "piece", "value", "features", "prediction", "found", "ids")})


# --- fingerprints


def fingerprint_rows(rows):
    """What the contract says, with plain sets."""
    rows = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
    out = {}
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        sets = [set(fingerprint.digests(t).tolist()) for t in (text, changed, following)]
        like = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out[doc_id] = len(text), hashlib.sha256(changed.encode()).hexdigest(), *like
    return out


def test_fingerprints(docs):
    got = fingerprint.fingerprints(clashing(docs)).collect()
    want = fingerprint_rows([(r.doc_id, r.text) for r in docs.collect()])
    assert len(got) == len(want)
    for r in got:
        n, sha, edited, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(edited) and r.near_next == pytest.approx(following)
    by_text = {}
    for r, d in zip(sorted(got, key=lambda r: r.doc_id), sorted(docs.collect(), key=lambda r: r.doc_id)):
        assert by_text.setdefault(d.text, r.fingerprint) == r.fingerprint


def test_fingerprints_of_odd_texts(odd):
    got = fingerprint.fingerprints(odd).collect()
    assert len(got) == len(ODD) and {r.doc_id for r in got} == {r[0] for r in ODD}
    of = {r.doc_id: r for r in got}
    want = fingerprint_rows([(r[0], r[1]) for r in ODD if r[0] != 10] + [(10, ODD[8][1])] * 2)
    assert all(of[i].edited_sha256 == want[i][1] for i in (9, 7, 5, 4, 3, 2, None))
    assert of[7].fingerprint == of[8].fingerprint and of[3].fingerprint == of[4].fingerprint == of[5].fingerprint
    assert of[8].near_next == 1.0 and of[5].near_next == 1.0 and of[2].near_next == 0.0


def test_fingerprints_of_one_and_none(spark, odd):
    assert fingerprint.fingerprints(odd.limit(0)).collect() == []
    one = fingerprint.fingerprints(spark.createDataFrame([(3, "a b\nc d\ne f\ng h")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


@pytest.mark.parametrize("ids, texts", [("null", "id"), ("null", "id % 7"), ("7", "0"), ("if(id % 3 = 0, 7, id)", "if(id % 2 = 0, 0, id)"), ("id", "id % 5"), ("id + 9000000000000000000", "id % 5")])
def test_fingerprints_of_hot_ids(spark, ids, texts):
    """A third of all rows, or all, with one id, or none, or one text: each row has the successor of one order, and no task holds much of them."""
    rows = spark.range(30_000).selectExpr(f"cast({ids} as long) doc_id", f"concat('text number ', {texts}, repeat(' and so on', cast({texts} % 3 as int))) text")
    got = fingerprint.fingerprints(rows)
    sizes = got.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.sum() == 30_000 and sizes.max() <= 2.5 * 30_000 / fingerprint.width(spark)
    order = sorted(
        ((d.doc_id, d.h, d.text) for d in rows.withColumn("h", F.xxhash64("text")).collect()),
        key=lambda r: (float("inf") if r[0] is None else -r[0], r[1]))
    want = Counter()
    for (doc_id, _, text), (_, _, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        want[doc_id, len(text), hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got.select("doc_id", "n_chars", "edited_sha256").collect()) == want


@pytest.mark.parametrize("size", [0, 3, 40, 5000])
def test_peeling_recovers_the_difference(size):
    rng = np.random.default_rng(size)
    common, a, b = (rng.integers(1, 1 << 63, n, dtype=np.uint64) for n in (1000, size, 2 * size))
    found = fingerprint.differences([np.concatenate([common, a])], [np.concatenate([b, common])])[0]
    assert sorted(found.tolist()) == sorted(np.concatenate([a, b]).tolist())


# --- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check_bpe(got, rows, library):
    assert len(got) == len(rows)
    want = {}
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        want[doc_id] = (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(),
        )
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id] for r in got)


def test_bpe_as_the_library(docs, ranks, library):
    check_bpe(bpe.digests(clashing(docs), ranks, public_tokenizers.PATTERN).collect(), [(r.doc_id, r.text) for r in docs.collect()], library)


def test_bpe_of_odd_texts(odd, ranks, library):
    check_bpe(bpe.digests(odd, ranks, public_tokenizers.PATTERN).collect(), [(r[0], r[1]) for r in ODD], library)
    assert bpe.digests(odd.limit(0), ranks, public_tokenizers.PATTERN).collect() == []
    ids = bpe.encode(odd.where("doc_id = 1"), ranks, public_tokenizers.PATTERN, out="lang").first()["lang"]
    assert ids == library.encode_ordinary("a b")


def test_bpe_beyond_the_memory(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 3)
    coder = bpe.Coder(ranks, public_tokenizers.PATTERN)
    rng = np.random.default_rng(3)
    for _ in range(3):
        texts = ["".join(rng.choice(list("aabcde  \n1!é"), 300)) for _ in range(5)]
        assert coder.encode(texts) == [library.encode_ordinary(t) for t in texts]


# --- language


def test_language_held_out(docs):
    got = {r.doc_id: r for r in language.identify(clashing(docs.withColumn("held_out", F.lit(1)))).collect()}
    rows = docs.collect()
    held = [r for r in rows if got[r.doc_id].held_out]
    assert held and sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_odd_texts(odd):
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(odd).collect()]
    assert len(got) == len(ODD)
    assert all((p, s) == ("und", 0.0) for i, p, s in got if i in (3, 4, 5))
    assert all(p in ("en", "de", "und") for _, p, _ in got)
    assert language.identify(odd.limit(0)).collect() == []
    nothing = language.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_backoff_goes_down_one_length_at_a_time():
    grams = {4: {"abcd": np.array([2.0, 1.0])}, 3: {"bcx": np.array([3.0, 0.0])}, 2: {"xx": np.array([0.0, 5.0])}, 1: {"q": np.array([1.0, 1.0])}}
    model = language.Model(["a", "b"], {"word": np.array([9.0, 9.0])}, grams)
    assert model.score_word("word").tolist() == [9, 9]
    assert model.score_word("abcd").tolist() == [1, 0] and model.score_word("bcx").tolist() == [1, -2]
    assert model.score_word("xxx").tolist() == [-3, 2] and model.score_word("q").tolist() == [-3, -3] and model.score_word("z").tolist() == [0, 0]


# --- toxicity


def test_toxicity_held_out(spark, sf):
    larger = sf.replace("0.001", "0.01")  # the smallest table has too few labels to learn from
    labels, docs = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("labels", "documents"))
    got = {r.doc_id: r for r in toxicity.judge(clashing(docs), labels).collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert sum(t == r.predicted for t, r in held) >= 0.9 * len(held) and sum(r.predicted for t, r in held if t) >= 0.7 * sum(t for t, _ in held)


def test_toxicity_of_odd_texts(spark, odd):
    few = spark.createDataFrame([(4, 1, 0), (7, 1, 1), (None, 1, 1), (2, 0, None), (2, 0, 0), (8, 0, 7)], "doc_id long, quality int, toxic int")
    for labels in (few, few.limit(0), few.where("toxic = 1")):
        got = toxicity.judge(odd, labels).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.judge(odd.limit(0), few).collect() == []


def test_texts_are_scored_as_their_words_are(monkeypatch):
    """Tables of remembered words give what the words give one by one, also when they are started anew between texts."""
    monkeypatch.setattr(language, "MEMO_WORDS", 3)
    one = lambda *x: np.array(x, np.float32)
    grams = {4: {"abcd": one(2, 1)}, 3: {"bcx": one(2, 0)}, 2: {"xx": one(-1, 4)}, 1: {"q": one(1, 1)}}
    model = language.Model(["a", "b"], {"word": one(9, 8)}, grams)
    scorer = language.Scorer(model)
    for text in ("word abcd bcx xxx q z", "z z z word", "abcd xxx xxx new words come here", "word abcd bcx xxx q z"):
        words = language.words_of(text)
        total = sum(model.score_word(w).astype(float) for w in words) / np.sqrt(len(words))
        lang, score = scorer(text)
        assert lang == ["a", "b"][int(np.argmax(total))] and abs(score - 1 / np.exp(total - total.max()).sum()) < 1e-6


def test_features_do_not_depend_on_what_is_remembered(monkeypatch):
    lexicon = toxicity.Lexicon(frozenset(["idiot"]), frozenset(["lowe"]))
    texts = ["You idiot!", "İstanbul ǅ 𝐀𝐁 x", "1d10t lowered, you LOWER?", "", "a-b (idiot) 'idiot", "Vous idiot). far from you all the while indeed idiot"]
    alone = [toxicity.Features(lexicon)(t) for t in texts]
    monkeypatch.setattr(toxicity, "MEMO_WORDS", 2)
    of = toxicity.Features(lexicon)
    assert [of(t) for t in [*texts, *texts]] == [*alone, *alone]


def test_features():
    of = toxicity.Features(toxicity.Lexicon(frozenset(["idiot"]), frozenset(["lowe"])))
    named = dict(zip(toxicity.FEATURES, of("You IDIOT! such an 1d10t, loweiß.")))
    assert named["hits"] == pytest.approx(np.log1p(1)) and named["undone_hits"] == pytest.approx(np.log1p(1)) and named["starts"] == pytest.approx(np.log1p(1))
    assert named["near_second_person"] == 1.0 and named["shouted"] == pytest.approx(1 / 6) and of(None) == of("") == [0.0] * len(toxicity.FEATURES)


# --- near-duplicates


def brute_components(rows, words, percent):
    sets = {}
    for doc_id, text in rows:
        found = (text or "").encode().lower().split()
        run = min(words, len(found))
        sets[doc_id] = {tuple(found[i:i + run]) for i in range(len(found) - run + 1)} if found else set()
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and common:
            a, b = sorted((top(a), top(b)))
            up[b] = a
    return {i: (len(sets[i]), top(i)) for i in sets}


@pytest.mark.parametrize("rule", [neardup.Rule(3, 85), neardup.Rule()])
def test_near_duplicates(docs, rule):
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()], rule.words, rule.percent)
    got = neardup.deduplicate(clashing(docs), rule).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(want)


def test_chains_of_near_copies(spark, monkeypatch):
    """A long chain, each text close to the next only, and a group of copies of one text, with small blocks and lists."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    rows = [(1000 + i, " ".join(words[i * 6:i * 6 + 120])) for i in range(60)]
    base = [f"b{i}" for i in rng.integers(0, 400, 150)]
    for i in range(80):
        changed = list(base)
        for at in rng.integers(0, 150, 3):
            changed[at] = f"n{i}{at}"
        rows.append((2000 + i, " ".join(changed)))
    rows += [(3000 + i, " ".join(base)) for i in range(50)]
    monkeypatch.setattr(neardup, "LIST_ROWS", 7)
    monkeypatch.setattr(neardup, "CELL_SHINGLES", 3000)
    monkeypatch.setattr(neardup, "COMMON_FROM", 3)
    got = neardup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), neardup.Rule(3, 85)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 3, 85)


def test_near_duplicates_of_odd_texts(odd):
    got = neardup.deduplicate(odd, neardup.Rule(3, 85)).collect()
    assert len(got) == len(ODD)
    of = {r.doc_id: r for r in got}
    assert [of[i].n_shingles for i in (5, 4, 3, 2, 1, 7)] == [0, 0, 0, 1, 1, 1]
    assert of[8].component_id == 7 and not of[8].kept and of[7].kept and all(of[i].component_id == i for i in (5, 4, 3, 2, 1, 9, 10))
    assert of[None].component_id is None and not of[None].kept
    assert neardup.deduplicate(odd.limit(0)).collect() == []


# --- packing


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("n,buckets", [(1, 3), (6, 1), (7, 3), (9, 4), (9, 20)])
def test_bounds_are_optimal(n, buckets):
    rng = np.random.default_rng(n)
    lengths, counts = np.sort(rng.choice(np.arange(1, 60), n, replace=False)), rng.integers(1, 50, n)
    bounds = packing.optimal_bounds(lengths, counts, buckets)
    every = [(*c, lengths[-1]) for k in range(min(buckets, n)) for c in itertools.combinations(lengths[:-1], k)]
    assert len(bounds) <= buckets and padding(lengths, counts, bounds) == min(padding(lengths, counts, b) for b in every)


def test_batches(docs):
    got = packing.pack(clashing(docs), budget=4096, max_length=256, slot_rows=50).toPandas()
    words = {r.doc_id: len(r.text.encode().split()) for r in docs.collect()}
    assert got.groupby("doc_id").n_words.sum().to_dict() == {i: n for i, n in words.items() if n}
    for bucket, rows in got.groupby("bucket"):
        room = max(1, 4096 // bucket)
        sizes = rows.groupby("batch").size()
        assert rows.n_words.max() <= bucket and sizes.index.tolist() == list(range(len(sizes)))
        assert (sizes.iloc[:-1] == room).all() and sizes.iloc[-1] <= room and not rows.duplicated(["batch", "position"]).any()


def test_packing_spreads_rows_without_id(spark):
    rows = spark.range(100_000).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("piece"), F.col("id").alias("row"), F.lit(20).cast("long").alias("slots"))
    held = sorted(r["count"] for r in rows.groupBy(packing.slot_of().alias("slot")).count().collect())
    assert len(held) == 20 and held[-1] < 2 * held[10]
    docs = spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    got = packing.pack(docs, budget=30, max_length=8, slot_rows=50).toPandas()
    assert len(got) == 300 and len(got.drop_duplicates(["bucket", "batch", "position"])) == 300
    assert set(got.groupby("batch").size()) == {10}


def test_packing_of_odd_texts(odd):
    got = packing.pack(odd).toPandas()
    assert set(got.doc_id.dropna()) == {2, 1, 7, 8, 9, 10} and got[got.doc_id == 7].n_words.sum() == 30_000
    assert (got.doc_id == 10).sum() == 2 and got.doc_id.isna().sum() == 1
    assert packing.pack(odd.limit(0)).collect() == []


def test_packing_pads_as_little_as_exact_lengths_allow(spark):
    """The bounds of pack() are the best among all lengths, not among some of them."""
    lengths = [9] * 60 + [n for n in range(1, 120, 3) for _ in range(1 + n % 4)]
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    got = packing.pack(docs, buckets=4).toPandas()
    values, counts = np.unique(lengths, return_counts=True)
    best = min(padding(values, counts, (*c, values[-1])) for c in itertools.combinations(values[:-1].tolist(), 3))
    assert (got.bucket - got.n_words).sum() == best


def test_repeats_of_an_id_are_one_text_of_their_cell(spark, monkeypatch):
    """Rows repeated under one id, also with other white space, take part in confirming once, and other texts of the id not at all."""
    base = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(base))] * 40 + [(1, "  ".join(base))] * 40 + [(1, "another text of one id")] + [(2, " ".join([*base[:-1], "end"]))]
    docs, asked, real = spark.createDataFrame(rows, "doc_id long, text string"), [], neardup.class_texts

    def counted(*given):
        out = real(*given)
        asked.extend(out.select("rep", "text").collect())
        return out
    monkeypatch.setattr(neardup, "class_texts", counted)
    got = neardup.deduplicate(docs.where("text not like 'another%'"), neardup.Rule(3, 85)).collect()
    assert sorted((r.rep, len(r.text.split())) for r in asked) == [(1, 100), (2, 100)]
    assert len(got) == 81 and {r.component_id for r in got} == {1} and {r.doc_id for r in got if r.kept} == {1}
    members = spark.createDataFrame([(1, 1, r.mark, 1, 1) for r in neardup.classes(docs.where("doc_id = 1"), neardup.Rule(3, 85))[1].where("n > 50").collect()], "rep long, doc_id long, mark binary, root long, blocks long")
    assert [len(r.text.split()) for r in real(docs, members, neardup.Rule(3, 85)).collect()] == [100]
