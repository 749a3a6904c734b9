"""Token alignment, spelling variants and approximate neighbours against brute force and on odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskmart.llm import align, neighbours, variants

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None, "", " ", "one", "a▁b", "<|endoftext|> <s></s> <0x41>", "日本語 😀 ß é́", "\x00\x01 ", " lead and tail \n\n\t", "x" * 20_000, "word " * 9_000,
    "same text twice", "same text twice", "don't stop ... 12345 ÄÖÜ",
]


def clashing(docs):
    return docs.withColumns({c: F.lit("x") for c in ("links", "groups", "pair", "n", "word", "form", "cell", "vector", "score", "place", "key")})


# --- alignment


def brute_alignment(texts):
    """Rows as the contract says, with the two libraries and plain dictionaries."""
    a_lib, b_lib = Tokenizer.from_file(LEFT), sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    a_lib.encode_special_tokens = True
    letters = align.byte_letters()

    def b_bytes(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    rows, pairs = [], Counter()
    for text in texts:
        encoded = a_lib.encode(" " + (text or ""), add_special_tokens=False)
        a, b = encoded.ids, b_lib.encode(text or "")
        a_bytes, b_all = [bytes(letters[c] for c in t) for t in encoded.tokens], [b_bytes(i) for i in b]
        if not text or b"".join(a_bytes) != f" {text}".encode() or b"".join(b_all) != f" {text}".encode():
            a, b, a_bytes, b_all = [], [], [], []
        ends = [np.cumsum([len(t) for t in side]).tolist() for side in (a_bytes, b_all)]
        at_b = {e: j for j, e in enumerate(ends[1])}
        cuts = [(i, at_b[e]) for i, e in enumerate(ends[0]) if e in at_b]
        links = [(a[i], b[j]) for i, j in cuts]
        pairs.update(links)
        starts = [(0, 0), *((i + 1, j + 1) for i, j in cuts)]
        line = ";".join(",".join(map(str, a[x:i + 1])) + "|" + ",".join(map(str, b[y:j + 1])) for (x, y), (i, j) in zip(starts, cuts))
        rows.append((len(a), len(b), len(cuts), links, line))
    highest = Counter()
    for (_, b), n in pairs.items():
        highest[b] = max(highest[b], n)
    out = [(na, nb, g, len(links), line, sum(pairs[p] == highest[p[1]] for p in links), sum(pairs[p] for p in links)) for na, nb, g, links, line in rows]
    return out, pairs


def test_alignment(spark, sf):
    own = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id here")]
    given = [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs = spark.createDataFrame(own + given, "doc_id long, text string").repartition(5)
    want, pairs = brute_alignment([t for _, t in own + given])
    got = align.align(clashing(docs), LEFT, RIGHT).collect()
    assert len(got) == len(want)
    by_id = {r.doc_id: r for r in got}
    for (i, _), row in zip(own + given, want):
        r = by_id[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) == row
    hashed = {r.doc_id: r.groups for r in align.align(docs, LEFT, RIGHT, digest=True).collect()}
    assert all(hashed[i] == (hashlib.sha256(row[4].encode()).hexdigest() if row[4] else "") for (i, _), row in zip(own + given, want))
    alignment = align.Alignment(LEFT, RIGHT)
    named = alignment.named(alignment.counts(alignment.rows(docs))).collect()
    assert {(r.a, r.b): r.n for r in named} == pairs


def test_alignment_of_nothing(spark):
    assert align.align(spark.createDataFrame([], "doc_id long, text string"), LEFT, RIGHT).collect() == []
    empty = align.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), LEFT, RIGHT).collect()
    assert [tuple(r)[1:] for r in empty] == [(0, 0, 0, 0, "", 0, 0)] * 2


def test_only_suffixes_are_pairs():
    found = align.endings([b"ab", b"b", b"xy"], [b"b", b"zab", b"y", b"b"])
    assert {(int(k >> 32), int(k & 0xFFFFFFFF)) for k in found} == {(0, 0), (0, 3), (0, 1), (1, 0), (1, 3), (1, 1), (2, 2)}
    with pytest.raises(ValueError):
        align.endings([b""], [b"a"])


# --- spelling variants


def brute_variants(rows, letters=6, least=5, factor=5, every=199):
    lower = str.maketrans(variants.UPPER, variants.LOWER)
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= least}

    def one_apart(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= factor * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_variants(spark, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK", 25)
    rng = np.random.default_rng(4)
    base = ["between", "Straße", "naïveté", "letters", "abcabc", "aaaaaa", "aaaaaaa", "abababab", "ÀÉÎabc", "keeping"]
    words = list(base)
    for word in base * 12:
        at = int(rng.integers(len(word) + 1))
        letter = "abcé"[int(rng.integers(4))]
        words.append([word[:at] + letter + word[at:], word[:at] + word[at + 1:], word[:at] + letter + word[at + 1:]][int(rng.integers(3))])
    rows = [(i, " ".join(w for w in rng.choice(words, 60, p=None))) for i in range(60)]
    rows += [(100 + i, " ".join(base) + " " + base[i % 10] * 3) for i in range(120)] + [(None, "between,between;BETWEEN " * 3), (7, None), (8, ""), (9, "x" * 30_000), (10, "y" * 30_000 + " "), (11, "1 2 3")]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for every in (199, 3):
        got = variants.spelling_variants(clashing(docs), every=every).collect()
        assert {tuple(r) for r in got} == brute_variants(rows, every=every) and len(got) == len(set(got))


def test_chains_of_forms(spark):
    words = [("letter" + "abcdefgh"[:i], 7 ** (8 - i)) for i in range(9)]
    got = {r.word: r for r in variants.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert all(r.root == "letter" for r in got.values()) and got["letterabc"].form == "letterab" and got["letter"].form is None


def test_variants_of_nothing(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert variants.spelling_variants(spark.createDataFrame([(1, None), (2, "few words")], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string"), letters=5)


def test_position_index():
    rng = np.random.default_rng(9)
    words = sorted({"".join(rng.choice(list("ab"), int(rng.integers(1, 8)))) for _ in range(200)})
    index = variants.PositionIndex(words)
    for word in words:
        near = {words[i] for i in range(len(words)) if index.near(word) >> i & 1}
        edits = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in "ab"} | {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in ("", "a", "b")}
        assert near == (edits & set(words)) - {word}


# --- approximate neighbours


def exact_neighbours(rows, k, every):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    best = {}
    for q, v in usable:
        if q % every:
            continue
        mine = best.setdefault(q, {})
        for c, w in usable:
            if c != q:
                size = max(len(v), len(w))
                a, b = (np.array([*x, *[0.0] * (size - len(x))], np.float64) for x in (v, w))
                mine[c] = max(mine.get(c, -2), float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))))
    return {q: sorted(((-s, c) for c, s in found.items()))[:k] for q, found in best.items() if found}


def as_lists(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r)
        assert r.rank == len(out[r.query_id])
    return out


def test_neighbours(spark, sf):
    given = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given.collect()]
    got, want = as_lists(neighbours.nearest(given, every=10).collect()), exact_neighbours(rows, 5, 10)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({r.vec_id for r in got[q]} & {c for _, c in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    vectors = dict(rows)
    for q, found in got.items():
        for r in found:
            a, b = (np.array(vectors[i], np.float64) for i in (q, r.vec_id))
            assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)


def test_neighbours_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 50)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(150)]
    rows += [(200 + i, rows[50][1]) for i in range(80)] + [(20, rows[21][1])] + rows[30:31] * 9 + [(400, [2 * x for x in rows[60][1]]), (60, rows[61][1])]
    rows += [(450, None), (None, rows[0][1]), (460, [0.0] * 8), (470, [1.0, None]), (480, [float("nan")] * 8), (490, [float("inf"), 1.0]), (500, []), (510, [1.0, 2.0]), (520, [0.5] * 11)]
    frame = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    monkeypatch.setattr(neighbours, "_radius", lambda *a: 10)  # so few are near enough that most queries are asked again
    got, want = as_lists(neighbours.nearest(frame, every=10).collect()), exact_neighbours(rows, 5, 10)
    assert got.keys() == want.keys()
    sure = [q for q in want if q in (50, 200, 210, 270)]
    assert sure and all([r.vec_id for r in got[q]] == [c for _, c in want[q]] for q in sure)
    monkeypatch.setattr(neighbours, "_radius", lambda *a: neighbours.BITS)
    whole = as_lists(neighbours.nearest(frame, every=10).collect())
    for q, best in want.items():
        assert [r.score for r in whole[q]] == pytest.approx([-s for s, _ in best], abs=1e-9)


def test_neighbours_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], schema)).collect() == []
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0])], schema)).collect() == []
    got = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [-2.0, 0.0]), (2, [0.0, 3.0])], schema)).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 2, 0.0), (0, 2, 1, -1.0)]
    huge = neighbours.nearest(spark.createDataFrame([(0, [1e200, 1e-200]), (1, [1e-220, 0.0])], "vec_id long, embedding array<double>")).collect()
    assert [tuple(r) for r in huge] == [(0, 1, 1, 1.0)]


def test_every_code_within_the_radius_is_retrieved():
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 256, (500, 8)).astype(np.uint8)
    index = neighbours.Substrings(codes)
    bits = np.unpackbits(codes, axis=1)
    for radius in (0, 3, 11, 17, 25, 31, 64):
        probes = index.probes(radius)
        for i in range(0, 500, 50):
            apart = (bits != bits[i]).sum(axis=1)
            assert set(index.within(codes[i], radius, probes)) == set(np.flatnonzero(apart <= radius))
