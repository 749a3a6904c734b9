"""Main-text extraction from HTML with a tree-structured graphical model.

The page is read into a tree of its block elements; inline elements belong to the block around them. Every block is content or not. Its
own potential is a weighted sum of its tag, words of its class, id and role, and of how much text and how much linked text it holds; a second potential joins it
to its parent, by kind of block. Messages go up from the leaves to the root and down again (sum-product), which is exact on a tree and gives every
block the marginal probability of being content. Text of blocks above one half is the result.

Weights are learned by maximum likelihood from labelled pages (``labelled_pages``): pages written from rules, in which the attribute ``data-main`` says where
content begins (1) and ends (0). Learning is deterministic and takes those pages only, so the model does not change with the data.

Character references are decoded, white space within a block becomes one space, blocks are trimmed and joined by one space in page order. Scripts, styles and comments
in markup are never text. A null or empty page has an empty text. Markup that is not closed ends with its parent.
"""

import itertools
import random
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import small_batches

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big button cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPH = frozenset("p blockquote pre figure figcaption dl dt dd li ul ol".split())
CELL = frozenset("table tbody thead tfoot tr td th".split())
BOX = frozenset("div section article main body html center".split())

#: A comment; a tag, which ends at the first ``>`` that is not in a quoted value, quotes counting only where a value starts; a declaration; a tag that never ends.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>=\s*+(?>"[^"]*"|'[^']*'|[^\s"'>][^\s>]*+)|[^>=]|=(?=\s*+>))*+)>|<[!?][^>]*>|</?[a-zA-Z].*\Z""", re.S)
#: What of RAW is text for the parser; an unclosed one of these takes the rest of the page, others are passed over.
PLAIN = frozenset("script style textarea title iframe".split())
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORD = re.compile(r"[a-z]+")


class Page:
    """Blocks of one page and its runs of text: parallel lists, a block's parent always before it."""

    __slots__ = ("parent", "tag", "attrs", "chars", "linked", "runs")

    def __init__(self, html: str):
        self.parent, self.tag, self.attrs, self.chars, self.linked = [-1], ["html"], [""], [0], [0]
        self.runs: list[tuple[int, list[str]]] = []
        self._read(html)

    def _read(self, html: str) -> None:
        stack, run, links, at = [0], [], 0, 0
        find = TOKEN.search
        while True:
            token = find(html, at)
            end = token.start() if token else len(html)
            if end > at:
                piece = unescape(html[at:end])
                run.append(piece)
                size = len(piece.strip())
                self.chars[stack[-1]] += size
                if links:
                    self.linked[stack[-1]] += size
            if token is None:
                break
            at = token.end()
            name = token[2]
            if name is None:
                continue
            name = name.lower()
            if name in INLINE:
                if name == "a":
                    links = 0 if token[1] else 1
                continue
            if name == "br":
                run.append("\n")
                continue
            if run:
                self.runs.append((stack[-1], run))
                run = []
            links = 0
            if token[1]:
                self._close(stack, name)
            elif name in RAW:
                close = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at) if not token[3].endswith("/") else None
                at = close.end() if close else (at if token[3].endswith("/") or name not in PLAIN else len(html))
            elif name not in VOID:
                self._open(stack, name, token[3])
        if run:
            self.runs.append((stack[-1], run))

    def _open(self, stack: list[int], name: str, attrs: str) -> None:
        if self.tag[stack[-1]] == "p" or (self.tag[stack[-1]] in HEADING and name in HEADING):
            stack.pop()
        if name in ENDS:
            ended, within = ENDS[name]
            for depth in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[depth]]
                if tag in within:
                    break
                if tag in ended:
                    del stack[depth:]
        if name == "html" and len(self.tag) == 1:
            self.attrs[0] = attrs
            return
        self.parent.append(stack[-1])
        self.tag.append(name)
        self.attrs.append(attrs)
        self.chars.append(0)
        self.linked.append(0)
        stack.append(len(self.tag) - 1)

    def _close(self, stack: list[int], name: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if self.tag[stack[depth]] == name:
                del stack[depth:]
                return

    def text(self, content) -> str:
        """Text of the blocks for which ``content`` holds, in page order."""
        blocks = (" ".join("".join(run).split()) for node, run in self.runs if content[node])
        return " ".join(b for b in blocks if b)


def kind(tag: str) -> int:
    """Kinds of blocks that differ in how they follow their parent."""
    return 0 if tag in HEADING else 1 if tag in PARAGRAPH else 2 if tag in ("div", "section") else 3 if tag in ("article", "main") else 5 if tag in CELL else 4


KINDS = 6
#: A name met on fewer training pages says no more than any name that was never met.
LEAST_PAGES = 3
NEW_WORD = "word ?"


def attribute_words(attrs: str) -> list[str]:
    out = []
    for name, *values in ATTRIBUTE.findall(attrs):
        if name.lower() != "data-main":
            out += WORD.findall(CAMEL.sub(" ", "".join(values)).lower())
    return out


def look(tag: str, attrs: str) -> tuple[str, ...]:
    """Features of a block that do not depend on its text."""
    words = attribute_words(attrs) if attrs else []
    return (f"tag {tag}", *dict.fromkeys(f"word {w}" for w in words), *(() if words else (f"bare {tag}",)))


def known_words(features: tuple[str, ...], known) -> list[str]:
    """Features with one common feature in place of the words that are not known."""
    return list(dict.fromkeys(f if f in known or not f.startswith("word ") else NEW_WORD for f in features))


def holder(tag: str) -> str:
    """Blocks alike in what their own text says: boxes by tag, others by kind."""
    return tag if tag in BOX else str(kind(tag))


def measure(of: str, chars: int, linked: int) -> tuple[str, ...]:
    """Features of the text that a block holds itself."""
    size = "none" if chars == 0 else "short" if chars < 40 else "long"
    return f"text {size}", f"text {size} {of}", "links " + ("most" if linked * 2 > chars else "few")


class Model:
    """Log potentials: ``own`` by feature (for content against not), ``pair`` by kind, parent's and own label."""

    def __init__(self, own: dict[str, float], pair: np.ndarray):
        self.own, self.pair = own, pair.tolist()
        ratio = np.exp(pair)
        self.up = ratio.tolist()
        self.memo: dict[tuple[str, str], tuple[str, float]] = {}
        self.texts = {(of, *k): sum(own.get(f, 0.0) for f in measure(of, *k)) for of in (*BOX, *map(str, range(KINDS))) for k in ((0, 0), (1, 0), (1, 1), (40, 0), (40, 40))}

    def potential(self, tag: str, attrs: str, chars: int, linked: int) -> float:
        known = self.memo.get((tag, attrs))
        if known is None:
            if len(self.memo) > 20_000:
                self.memo.clear()
            known = self.memo[tag, attrs] = holder(tag), sum(self.own.get(f, 0.0) for f in known_words(look(tag, attrs), self.own))
        size = 0 if chars == 0 else 1 if chars < 40 else 40
        return known[1] + self.texts[known[0], size, size if size and linked * 2 > chars else 0]

    def marginals(self, page: Page) -> list[float]:
        """Probability of each block being content, by messages up and down the tree."""
        n, parent = len(page.tag), page.parent
        belief = []
        for tag, attrs, chars, linked in zip(page.tag, page.attrs, page.chars, page.linked):
            own = max(-30.0, min(30.0, self.potential(tag, attrs, chars, linked)))
            odds = 2.718281828459045 ** own
            belief.append([1 / (1 + odds), odds / (1 + odds)])
        sent: list = [None] * n
        for v in range(n - 1, 0, -1):
            p, (b0, b1) = self.up[kind(page.tag[v])], belief[v]
            m0, m1 = p[0][0] * b0 + p[0][1] * b1, p[1][0] * b0 + p[1][1] * b1
            total = m0 + m1
            m0, m1 = m0 / total, m1 / total
            sent[v] = (m0, m1)
            up = belief[parent[v]]
            a0, a1 = up[0] * m0, up[1] * m1
            total = a0 + a1
            up[0], up[1] = a0 / total, a1 / total
        for v in range(1, n):
            p, (m0, m1), up, own = self.up[kind(page.tag[v])], sent[v], belief[parent[v]], belief[v]
            c0, c1 = up[0] / m0, up[1] / m1
            a0, a1 = own[0] * (c0 * p[0][0] + c1 * p[1][0]), own[1] * (c0 * p[0][1] + c1 * p[1][1])
            total = a0 + a1
            own[0], own[1] = a0 / total, a1 / total
        return [b[1] for b in belief]

    def extract(self, html: str | None) -> str:
        if not html:
            return ""
        page = Page(html)
        return page.text([m > 0.5 for m in self.marginals(page)])


def labels_of(page: Page) -> list[int]:
    """Labels of a labelled page: a block has its own mark, else its parent's."""
    out = []
    for parent, attrs in zip(page.parent, page.attrs):
        mark = next(("".join(v) for name, *v in ATTRIBUTE.findall(attrs) if name.lower() == "data-main"), None)
        out.append(int(mark) if mark is not None else out[parent] if parent >= 0 else 0)
    return out


class Forest:
    """Blocks of many pages, by depth, for exact inference on all of them at once."""

    def __init__(self, pages: list[Page]):
        parents, kinds, depths, start = [], [], [], 0
        for page in pages:
            depth: list[int] = []
            for v, p in enumerate(page.parent):
                depth.append(depth[p] + 1 if p >= 0 else 0)
                parents.append(start + p if p >= 0 else -1)
                kinds.append(kind(page.tag[v]))
            depths += depth
            start += len(depth)
        self.parent, self.kind, depth = np.array(parents), np.array(kinds), np.array(depths)
        self.levels = [np.flatnonzero(depth == d) for d in range(depth.max() + 1)]

    def marginals(self, own: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-domain sum-product: chances of each block's labels, and of each (parent's label, own label)."""
        belief = np.stack([np.zeros_like(own), own], axis=1)
        sent = np.zeros_like(belief)
        for level in self.levels[:0:-1]:
            sent[level] = np.logaddexp.reduce(pair[self.kind[level]] + belief[level][:, None, :], axis=2)
            np.add.at(belief, self.parent[level], sent[level])
        joint = np.zeros((len(own), 2, 2))
        chance = np.zeros_like(belief)
        for d, level in enumerate(self.levels):
            if d == 0:
                log = belief[level]
            else:
                above = self.parent[level]
                edge = (np.log(chance[above]) - sent[level])[:, :, None] + pair[self.kind[level]] + belief[level][:, None, :]
                edge = np.exp(edge - edge.max(axis=(1, 2), keepdims=True))
                joint[level] = edge / edge.sum(axis=(1, 2), keepdims=True)
                log = np.log(joint[level].sum(axis=1) + 1e-300)
            part = np.exp(log - log.max(axis=1, keepdims=True))
            chance[level] = np.maximum(part / part.sum(axis=1, keepdims=True), 1e-12)
        return chance, joint


def learn(pages: list[str], rounds: int = 250, rate: float = 0.1, penalty: float = 1e-3) -> Model:
    """Maximum likelihood: the gradient is what the labels show less what sum-product expects."""
    read = [Page(html) for html in pages]
    met = Counter(f for page in read for f in {f for t, a in zip(page.tag, page.attrs) for f in look(t, a)})
    known = {f for f, n in met.items() if n >= LEAST_PAGES}
    names: dict[str, int] = {}
    rows = [
        [names.setdefault(f, len(names)) for f in (*known_words(look(t, a), known), *measure(holder(t), c, k))]
        for page in read for t, a, c, k in zip(page.tag, page.attrs, page.chars, page.linked)
    ]
    x = np.zeros((len(rows), len(names)))
    for i, row in enumerate(rows):
        x[i, row] = 1.0
    y = np.concatenate([labels_of(page) for page in read])
    forest = Forest(read)
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((len(rows), 2, 2))
    seen[child, y[forest.parent[child]], y[child]] = 1.0
    weights = np.zeros(len(names) + 4 * KINDS)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        pair = weights[len(names):].reshape(KINDS, 2, 2)
        chance, joint = forest.marginals(x @ weights[:len(names)], pair)
        by_kind = np.zeros((KINDS, 2, 2))
        np.add.at(by_kind, forest.kind[child], (seen - joint)[child])
        slope = np.concatenate([x.T @ (y - chance[:, 1]), by_kind.ravel()]) / len(pages) - penalty * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights = weights + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model({name: float(weights[i]) for name, i in names.items()}, weights[len(names):].reshape(KINDS, 2, 2))


BODIES = (
    ("article", ""), ("article", 'class="post"'), ("main", ""), ("main", 'id="main"'), ("div", 'id="content"'), ("div", 'class="article-body"'), ("div", 'class="entry content"'),
    ("section", 'class="story"'), ("div", 'class="post text"'), ("div", 'role="main"'),
    ("article", 'class="{0}"'), ("main", 'id="{0}"'), ("article", ""), ("main", ""),
)
#: Places of content that no name tells: the page itself, boxes without a name or with a new one ({0}), cells of layout tables.
OPEN = ("body", "html", "<div{1}>{2}</div>", '<div{1} class="{0}">{2}</div>', '<section{1} id="{0}">{2}</section>', '<div{1} class="{0}"><div class="{0}">{2}</div></div>', "table", "center")
CELL_CLUTTER = ("menu", "nav", "sidebar", "ad", "ads banner", "header", "footer", "related", "advert")
ASIDES = (
    "<nav{0}><ul><li><a href='/a'>{1}</a></li><li><a href='/b'>{2}</a></li></ul></nav>", "<header{0}><div>{1}</div><a href='/'>{2}</a></header>",
    "<footer{0}>&copy; {1} &middot; {2}</footer>", "<footer{0}><p>{1}</p><p>{2}</p></footer>", "<aside{0}><h3>{1}</h3><p>{2}</p></aside>", "<aside{0}><ul><li>{1}</li><li>{2}</li></ul></aside>",
    '<div{0} class="ad">{1} {2}</div>', '<div{0} class="ads banner"><p>{1}</p><p>{2}</p></div>', '<div{0} class="advert"><p>{2}</p></div>', '<div{0} id="sponsored promo"><p>{2}</p></div>',
    '<div{0} class="sidebar widget"><h4>{1}</h4><p>{2}</p></div>', '<div{0} id="cookie-notice"><p>{2}</p></div>', '<div{0} class="notice consent"><p>{1}</p></div>',
    '<div{0} class="alert popup modal">{2}</div>', "<form{0}><p>{1}</p><div>{2}</div><fieldset>{1}</fieldset></form>", '<div{0} class="newsletter subscribe"><p>{1}</p><form><p>{2}</p></form></div>',
    '<div{0} id="comments"><h3>{1}</h3><div class="comment"><p>{2}</p></div><div class="comment"><p>{1}</p></div></div>',
    '<section{0} class="comments"><ol><li>{2}</li><li>{1}</li></ol></section>', '<section{0} class="reader responses discussion replies"><p>{1}</p><p>{2}</p></section>', '<div{0} class="menu nav"><ul><li><a href="/c">{1}</a></li></ul></div>',
    '<div{0} class="related recommended more"><ul><li><a href="/d">{2}</a></li></ul></div>', '<div{0} class="share social"><a href="/e">{1}</a></div>', '<ul{0} class="breadcrumb"><li><a href="/f">{1}</a></li></ul>',
    '<div{0} class="footer copyright"><p>{2}</p></div>', '<div{0} class="header masthead top"><p>{1}</p></div>', '<div{0} role="navigation"><p>{1}</p></div>', '<div{0} role="banner"><p>{2}</p></div>',
    '<div{0} role="complementary"><p>{2}</p></div>', '<div{0} role="contentinfo"><p>{1}</p></div>', '<dialog{0}><p>{2}</p></dialog>', '<menu{0}><li>{1}</li></menu>',
)
SOUNDS = "ba ke li mo nu ra se ti vo za".split()


def labelled_pages(n: int = 660, seed: int = 11) -> list[str]:
    """Training pages written from rules: one body, named or not, with other blocks before, after and within it."""
    draw = random.Random(seed)

    def words(least: int, most: int) -> str:
        return " ".join("".join(draw.choices(SOUNDS, k=draw.randint(1, 4))) for _ in range(draw.randint(least, most)))

    def others(count: int, mark: str) -> str:
        return "".join(draw.choice(ASIDES).format(mark, words(1, 6), words(1, 30)) for _ in range(count))

    def name() -> str:
        return "".join(draw.choices(SOUNDS, k=4))

    def content(bare: bool) -> str:
        parts = [f"<h1>{words(1, 8)}</h1>"] if draw.random() < 0.8 else []
        for _ in range(draw.randint(1, 7)):
            forms = (
                "<p>{0}</p>", "<p>{0}</p>", "<p>{0}</p>", "<p>{0}", "<p><b>{0}<br><p>{1}</p>", "<h2>{1}</h2>", "<ul><li>{1}</li><li>{0}</li></ul>", "<blockquote><p>{0}</p></blockquote>", "<div>{0}</div>",
                "<section><h3>{1}</h3><p>{0}</p></section>", "<table><tr><td>{1}</td><td>{0}</td></tr></table>", "<div><p>{0}</p><p>{1}</p></div>", "<p><a href='/x'>{1}</a> {0}</p>", "<pre>{0}</pre>",
            )
            if bare:
                forms += ("{0}<br>{1}", "{0}<br><br>{0}", "<div class='{2}'><p>{0}</p></div>", "<div class='{2}'>{0}</div>", "<ol><li>{0}</li></ol>", "<dl><dt>{1}</dt><dd>{0}</dd></dl>")
            parts.append(draw.choice(forms).format(words(1, 60), words(1, 5), name()))
            if draw.random() < 0.2:
                parts.append(others(1, ' data-main="0"'))
        return "".join(parts)

    def open_page(place: str) -> str:
        """Content that no box names, between marked clutter."""
        off, on = ' data-main="0"', ' data-main="1"'
        before, after = others(draw.randint(0, 3), off), others(draw.randint(0, 3), off)
        head = f"<head{off}><title>{words(1, 5)}</title></head>"
        if place in ("html", "body"):
            inner = content(True) if draw.random() < 0.7 else "<br>".join(words(5, 60) for _ in range(draw.randint(1, 4)))
            return f"<html{on}>{head}{before}{inner}{after}" if place == "html" else f"<html>{head}<body{on}>{before}{inner}{after}</body></html>"
        if place == "center":
            return f"<html>{head}<body>{before}<center{on}>{content(True)}</center>{after}</body></html>"
        if place == "table":
            side = f"<td>{others(1, off)}</td>" if draw.random() < 0.5 else f'<td{off} class="{draw.choice(CELL_CLUTTER)}">{words(1, 20)}</td>'
            cells = [side, f"<td>{content(True)}</td>"]
            draw.shuffle(cells)
            top = f"<tr><td>{others(1, off)}</td></tr>" if draw.random() < 0.5 else ""
            return f"<html>{head}<body>{before}<table{on}>{top}<tr>{''.join(cells)}</tr></table>{after}</body></html>"
        box = place.format(name(), on, content(True))
        if draw.random() < 0.3:
            box = f'<div class="{draw.choice(("wrapper", "container", "page", "site row", "layout", name()))}">{others(draw.randint(0, 1), off)}{box}{others(1, off)}</div>'
        return f"<html>{head}<body>{before}{box}{after}</body></html>"

    pages = []
    for place in itertools.islice(itertools.cycle((*BODIES, *OPEN)), n):
        if isinstance(place, str):
            pages.append(open_page(place))
            continue
        tag, attrs = place
        body = f'<{tag} data-main="1" {attrs.format(name())}>{content(False)}</{tag}>'
        if draw.random() < 0.3:
            body = f'<div class="{draw.choice(("wrapper", "container", "page", "site row", "layout"))}">{body}{others(1, "")}</div>'
        page = f"{others(draw.randint(0, 3), '')}{body}{others(draw.randint(0, 3), '')}"
        pages.append(page if draw.random() < 0.2 else f"<html><head><title>{words(1, 5)}</title></head><body>{page}</body></html>")
    return pages


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model or learn(labelled_pages()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [model.extract(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
