"""Corpus operators on vectors, calls, URLs and pages, and the pipeline, against brute force and on odd input."""

import json
import math

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import html, neardup, packing, queries, tools, topk, toxicity, urls

# --- exact top-k


def brute_top(rows, k, every, scale):
    usable = {(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, v in usable:
        if q % every == 0:
            scores = {(c, sum(a * b for a, b in zip(v, w))) for c, w in usable if c != q}
            out += [(q, c, s) for c, s in scores]
    best = {}
    for q, c, s in set(out):
        best.setdefault(q, []).append((-s, c))
    return {(q, n, c, -s) for q, found in best.items() for n, (s, c) in enumerate(sorted(found)[:k], 1)}


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_ROWS", 40)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 4]) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(60)] + rows[100:101] * 5
    rows += [(300, None), (None, rows[0][1]), (310, [1.0, None]), (320, [float("nan")] * 6), (330, [float("inf")] * 6), (340, []), (350, [0.0] * 6), (360, [0.5] * 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cell": F.lit(1), "dims": F.lit("x"), "score": F.lit(2)})
    got = topk.top_k(frame, k=4, every=10, scale=8).collect()
    assert {tuple(r) for r in got} == brute_top(rows, 4, 10, 8) and len(got) == len(set(got))


def test_top_k_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema)).collect() == []
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [-2.0])], schema)).collect()] == [(0, 1, 1, -2 * 1024 * 1024)]


# --- tool calls

SCHEMAS = {"find": {"text": "string", "n": "?integer"}, "sum": {"of": "array", "exact": "boolean"}}


@pytest.fixture(scope="module")
def linked(spark):
    calls = [
        (1, "a", 1, "find", '{"n": 3, "text": "x\\"y"}', None), (1, "b", 3, "sum", '{"of":[2,1],"exact":true}', ["a", "lost"]),
        (2, "a", 5, "find", '{"text":"p"}', ["b"]), (2, "b", 6, "find", '{"text":"q"}', ["c"]), (2, "c", 7, "find", '{"text":"r"}', []),
        (3, "a", 1, "find", '{"text":1}', ["b"]), (3, "b", 2, "find", '{"n":1}', ["a"]), (3, "c", 3, "find", '{"text":"t"}', ["a"]),
        (4, "a", 1, "other", "{}", []), (4, "b", 2, "find", "not json", []), (4, "c", 3, "find", '{"text":"t","more":1}', []), (4, "d", 4, None, None, []), (4, "e", 5, "find", "[1]", []),
        (5, "a", 2, "find", '{"text":"later"}', []), (5, "a", 1, "find", '{"text":"first"}', []), (5, "a", 1, "find", '{"text":"first"}', []),
        (6, "a", 1, "find", '{"text":"t"}', ["b", "c"]), (6, "b", 2, "find", '{"text":"t"}', ["c"]), (6, "c", 3, "find", '{"text":"t"}', []), (None, "z", 1, "find", "{}", []), (7, None, 1, "find", "{}", []),
    ]
    results = [(1, "a", 2, "ok"), (1, "a", 9, "again"), (2, "a", 8, None), (9, "q", 1, "alone"), (None, "a", 1, "lost"), (5, "a", 3, "é\n")]
    frame = spark.createDataFrame(calls, "conv_id long, call_id string, position long, name string, arguments string, needs array<string>")
    answers = spark.createDataFrame(results, "conv_id long, call_id string, position long, content string").withColumn("name", F.lit("clash")).withColumn("stage", F.lit(4))
    got = tools.link(frame.withColumn("content", F.lit("clash")), answers, SCHEMAS).collect()
    assert len({(r.conv_id, r.call_id) for r in got}) == len(got) == 18
    return {(r.conv_id, r.call_id): r for r in got}


def test_links(linked):
    assert {k: r.state for k, r in linked.items() if r.state != "pending"} == {(1, "a"): "linked", (2, "a"): "linked", (5, "a"): "linked", (9, "q"): "orphan"}
    assert linked[1, "a"].line == '{"arguments":{"n":3,"text":"x\\"y"},"id":"a","name":"find","result":"ok"}'
    assert linked[1, "b"].line == '{"arguments":{"exact":true,"of":[2,1]},"id":"b","name":"sum","result":null}'
    assert linked[5, "a"].repeats == 2 and json.loads(linked[5, "a"].line) == {"arguments": {"text": "first"}, "id": "a", "name": "find", "result": "é\n"}
    assert json.loads(linked[4, "b"].line)["arguments"] == "not json" and json.loads(linked[4, "d"].line)["arguments"] is None
    assert json.loads(linked[9, "q"].line) == {"arguments": None, "id": "q", "name": None, "result": "alone"} and linked[9, "q"].position == 1


def test_order(linked):
    assert [linked[2, c].stage for c in "abc"] == [2, 1, 0] and [linked[6, c].stage for c in "abc"] == [2, 1, 0]
    assert [linked[1, c].stage for c in "ab"] == [0, 0] and [linked[3, c].stage for c in "abc"] == [None] * 3


def test_problems(linked):
    found = {k: r.problem for k, r in linked.items() if r.problem}
    assert found == {
        (3, "a"): "type text", (3, "b"): "missing text", (3, "c"): "cycle", (4, "a"): "unknown tool", (4, "b"): "malformed", (4, "c"): "extra more", (4, "d"): "malformed", (4, "e"): "malformed",
    }


def test_long_chain_and_no_calls(spark):
    n = 300
    rows = [(1, f"c{i}", i, "find", "{}", [f"c{i + 1}"]) for i in range(n)]
    schema = "conv_id long, call_id string, position long, name string, arguments string, needs array<string>"
    frame, none = spark.createDataFrame(rows, schema), spark.createDataFrame([], "conv_id long, call_id string, position long, content string")
    got = tools.link(frame, none, SCHEMAS)
    assert {r.call_id: r.stage for r in got.collect()} == {f"c{i}": n - 1 - i for i in range(n)}
    assert "Python" not in got._jdf.queryExecution().toString() and "InPandas" not in got._jdf.queryExecution().toString()
    assert tools.link(frame.limit(0), none, SCHEMAS).collect() == []


# --- URL filters

ODD_URLS = [
    None, "", "no scheme/x", "http://", "HTTP://WWW.Example.NET/en/A", "http://a.net", "http://a.net/", "http://net/x", "http://xnet/", "https://a.org/fr/?q#f", "https://a.org/fr?x", "http://b.example.net/en/1",
    "http://notexample.net/en/1", "x://y://example.com/de/", "http://example.com/de", "http://example.com?u=/de/", "http://É.org/fr/\nx", "http://example.com:80/de/", "http://a.net/" + "x/" * 5000, "http://a.net/",
]


def brute_verdict(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:] if rest[cut:].startswith("/") else ""
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    won = max(fits, key=lambda r: r.strength, default=None)
    return host, path, won and won.text, won.verdict if won else default


@pytest.mark.parametrize("max_chars", [1 << 20, 0])
def test_urls(spark, max_chars):
    more = [urls.Rule.read(*r) for r in (("allow", "example.com/de/x"), ("block", "a.org"), ("allow", "a.org"), ("block", "b.example.net/e"), ("allow", "net/x/x/"))]
    rules = queries.RULES + more
    frame = spark.createDataFrame(list(enumerate(ODD_URLS)), "page_id long, url string").withColumns({"host": F.lit(1), "path": F.lit(2), "rule": F.lit(3), "won": F.lit(4), "at": F.lit(5)})
    got = {r.page_id: tuple(r)[1:] for r in urls.judge(frame, rules, "allow", max_chars).collect()}
    assert got == {i: brute_verdict(u, rules, "allow") for i, u in enumerate(ODD_URLS)}
    assert urls.judge(frame.limit(0), rules, "allow", max_chars).collect() == []


# --- main text


@pytest.fixture(scope="module")
def model():
    return html.learn(html.labelled_pages())


def test_pages_kept_apart_from_training(model):
    pages = html.labelled_pages(300, seed=77)
    wrong = 0
    for labelled in pages:
        page = html.Page(labelled)
        wrong += model.extract(labelled.replace(' data-main="1"', "").replace(' data-main="0"', "")) != page.text(html.labels_of(page))
    assert wrong <= 0.03 * len(pages)


def test_marginals_are_exact(model):
    """Messages on the tree give what summing over all labellings gives."""
    page = html.Page('<body><nav>a</nav><div id="content"><p>text here</p><div class="ad"><p>buy</p></div></div></body>')
    n = len(page.tag)
    own = [model.potential(page.tag[v], page.attrs[v], page.chars[v], page.linked[v]) for v in range(n)]
    total, on = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [(bits >> v) & 1 for v in range(n)]
        weight = math.exp(sum(own[v] * y[v] for v in range(n)) + sum(model.pair[html.kind(page.tag[v])][y[page.parent[v]]][y[v]] for v in range(1, n)))
        total += weight
        on += weight * np.array(y)
    assert model.marginals(page) == pytest.approx((on / total).tolist())


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""),
    ("<body><nav><a href=x>menu</a></nav><article><h1>T &amp; t</h1><p>a<b>b</b>\n  c&nbsp;d<br>e<p>f</article><div id=comments><p>reader</p></div>", "T & t ab c d e f"),
    ("<article><script>var a='<p>no</p>';</script><p>yes &lt;p&gt;</p><!-- <p>no</p> --><style>p{}</style></article><footer>no</footer>", "yes <p>"),
    ("<main><p>one<form><p>no</p><input value='x>y'></form><p>two 1 < 2</main>", "one two 1 < 2"),
    ("<article><p>cut off <b>here", "cut off here"),
])
def test_extraction(model, page, text):
    assert model.extract(page) == text


def test_pages_frame(spark):
    rows = [(1, "u", "<article><p>x</p></article>"), (None, None, None), (3, "v", ""), (3, "v", "<article>" + "<div>" * 3000 + "<p>deep" + " word" * 50_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("clash"), "n_chars": F.lit("clash")})
    got = html.extract(frame).collect()
    assert sorted((r.page_id or 0, r.url, r.n_chars) for r in got if r.n_chars < 10) == [(0, None, 0), (1, "u", 1), (3, "v", 0)] and len(got) == 4
    assert html.extract(frame.limit(0)).collect() == []


# --- pipeline


def test_pipeline(spark, sf):
    sf = sf.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"score": F.lit(1), "kept": F.lit("x")})
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language", "near_duplicates", "packing"]
    kept = neardup.stored(stages["toxicity"](spark, docs, sf), "t")
    judged = {r.doc_id for r in toxicity.judge(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect() if not r.predicted}
    assert {r.doc_id for r in kept.collect()} == judged and kept.columns == docs.columns
    assert sum(labels.get(i) == 0 for i in set(before) - judged) <= 0.05 * len(before)
    spoken = neardup.stored(stages["language"](spark, kept, sf), "l")
    assert spoken.count() >= 0.99 * kept.count() and spoken.columns == docs.columns
    single = neardup.stored(stages["near_duplicates"](spark, spoken.unionByName(spoken.limit(3)), sf), "n")
    heads = {r.doc_id for r in neardup.deduplicate(spoken).collect() if r.kept}
    rows = single.collect()
    assert {r.doc_id for r in rows} == heads and len(rows) == len(heads) and all(r.text == before[r.doc_id].text for r in rows)
    packed = stages["packing"](spark, single, sf)
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, packing.pack(single).collect()))
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() == packed.select("doc_id").distinct().count()


def test_pipeline_of_odd_documents(spark, sf, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "a b c", "en", "s", 5), (4, "x y z " * 40_000, "en", "s", 1), (4, "x y z " * 40_000, "en", "s", 1)]
    for n, docs in (("all", rows), ("none", [])):
        place = str(tmp_path / n)
        spark.createDataFrame(docs, schema).write.parquet(f"{place}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
        got = corpus_pipeline.run(spark, place).toPandas()
        assert set(got.doc_id.dropna()) == ({4} if docs else set()) and got[got.doc_id == 4].n_words.sum() == (120_000 if docs else 0)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


# --- main text that no name tells

LONG = "<p>a paragraph of the text that says a good deal about one thing and goes on for a while</p>"
CLUTTER = (
    "<nav><ul><li><a href='/a'>menu</a></li></ul></nav>", '<div class="ad">buy now</div>', '<div id="cookie-notice"><p>we keep what you like</p></div>',
    '<div class="sidebar widget"><h4>see</h4><p>other things of interest to the readers of this page here</p></div>', "<footer><p>all rights are kept by someone</p></footer>",
)


@pytest.mark.parametrize("around", [
    "<html><head><title>t</title></head><body>{0}<h1>T</h1>{1}{2}{1}{0}</body></html>", "{0}<h1>T</h1>{1}{2}{1}{0}", "<body>{0}<div class='prose'><h1>T</h1>{1}{2}{1}</div>{0}</body>",
    "<body>{0}<div id='xk9'><h1>T</h1>{1}{2}{1}</div>{0}</body>", "<body>{0}<div><div><h1>T</h1>{1}{2}{1}</div></div>{0}</body>", "<body>{0}<section class='zone-b'><h1>T</h1>{1}{2}{1}</section>{0}</body>",
    "<body>{0}<table><tr><td>{2}</td><td><h1>T</h1>{1}{1}</td></tr></table>{0}</body>", "<body><table><tr><td class='menu'><a href='/b'>go</a></td><td><h1>T</h1>{1}{1}</td></tr></table>{0}</body>",
])
def test_content_in_places_without_a_telling_name(model, around):
    """Directly under the page's body, in unknown or unnamed boxes and in cells: the whole text, and none of the marked clutter."""
    text = html.Page(LONG).text([1] * 3)
    for clutter in CLUTTER:
        assert model.extract(around.format(clutter, LONG, CLUTTER[1])) == f"T {text} {text}"


def test_text_directly_under_body(model):
    page = "<body>{0}Plain text that stands in no box and goes on for quite some while.<br>More of it that is as long.{0}</body>"
    for clutter in CLUTTER:
        assert model.extract(page.format(clutter)) == "Plain text that stands in no box and goes on for quite some while. More of it that is as long."


def test_open_pages_keep_their_text(model):
    """Of held-out pages whose content no name tells, nearly all words are kept and nearly all clutter goes."""
    places, lost, kept, wanted = [*html.BODIES, *html.OPEN], 0, 0, 0
    for i, labelled in enumerate(html.labelled_pages(360, seed=78)):
        if isinstance(places[i % len(places)], tuple):
            continue
        page = html.Page(labelled)
        want = page.text(html.labels_of(page))
        got = model.extract(labelled.replace(' data-main="1"', "").replace(' data-main="0"', ""))
        wanted, lost, kept = wanted + len(want), lost + max(0, len(want) - len(got)), kept + max(0, len(got) - len(want))
    assert lost <= 0.02 * wanted and kept <= 0.02 * wanted


def test_near_duplicate_stage_with_clashing_ids(spark):
    """Two texts share an id: only the near copy goes, the unique text and the repeated row stay once."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "s"), (5, a + " end", "s"), (5, b, "s"), (7, c, "t"), (7, c, "s"), (7, c, "s"), (9, b + " end", "s"), (8, None, "s"), (8, "", "s"), (None, a, "s"), (None, a, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, a, "s"), (5, b, "s"), (7, c, "s"), (8, None, "s"), (8, "", "s"), (None, a, "s"), (None, a, "s")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_language_stage_by_what_was_met(spark, sf):
    """With two languages a script that was never learned goes; short clean texts stay, also where many languages share them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang in ('en', 'de')").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "\u03b1\u03b2\u03b3 \u03b4\u03b5\u03b6 \u03b7\u03b8", None), (-2, "12 34", None)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs.unionByName(odd), sf).collect()}
    assert not kept & {-1, -2} and len(kept) >= 0.99 * docs.count()
    many = spark.createDataFrame([(i, "one short clean text", f"l{i % 30}") for i in range(300)], docs.schema)
    assert corpus_pipeline.language_stage(spark, many, sf).count() == 300


@pytest.mark.parametrize("body, want", [
    ("<p title=don't>First words here.</p><p>And more of them.</p>", ["First words here.", "And more of them."]),
    ('<p class="x"">First words here.</p>', ["First words here."]), ('<p>First words here.</p><p title="never closed>Lost', ["First words here."]),
    ("<p data-x='a > b' y = z\"q>First words here.</p>", ["First words here."]), ("<p>First</p><svg><p>Second</p>", ["First", "Second"]),
    ("<p>First</p><noscript><p>Second</p>", ["First", "Second"]), ("<p>First</p><script>var x = '<p>no</p>'", ["First"]), ("<p/class=a>First</p>", ["First"]),
])
def test_stray_quotes_and_unclosed_tags(body, want):
    page = html.Page(f"<html><body><article>{body}")
    assert [" ".join("".join(run).split()) for _, run in page.runs] == want
