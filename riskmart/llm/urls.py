"""URL filters: a trie over reversed host labels and then path segments, longest match first.

A rule is a host and a path, written ``example.net/en/``. It fits its host and all subdomains if the URL's path starts with the rule's path.
Rules are kept in a trie: the host's labels from the right, then the path's whole segments, then the rest of the path, which any
segment may continue. A URL walks the trie once; of the rules on its way the one with the most host labels wins, then the one with the longest path, then block
before allow. No rule: ``default``.

The trie is broadcast while the rules have at most ``MAX_CHARS`` characters. Larger rule sets are matched by equi-joins on every suffix of the host
and the rules' path lengths instead, with the same result. Null URLs, and those without ``://``, have empty host and path.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.shared import shipped

MAX_CHARS = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @staticmethod
    def read(verdict: str, text: str) -> "Rule":
        host, slash, path = text.partition("/")
        return Rule(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def strength(self) -> tuple:
        return len(self.host.split(".")), len(self.path), self.verdict == "block"


@dataclass
class Node:
    labels: dict = field(default_factory=dict)
    segments: dict = field(default_factory=dict)
    rules: list = field(default_factory=list)


def build(rules: list[Rule]) -> Node:
    root = Node()
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.labels.setdefault(label, Node())
        *whole, _ = rule.path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        node.rules.append(rule)
    return root


def match(root: Node, host: str, path: str) -> Rule | None:
    """The strongest rule that fits."""
    best = None
    node = root
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        place, parts, i = node, path.split("/"), 0
        while place is not None:
            for rule in place.rules:
                if path.startswith(rule.path) and (best is None or rule.strength > best.strength):
                    best = rule
            if i >= len(parts) - 1:
                break
            place, i = place.segments.get(parts[i]), i + 1
    return best


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) up to the first ``/``, ``?`` or ``#`` after ``://``, and the path after it."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)://(.*)", 1)).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def by_trie(hosts: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    shipped(hosts.sparkSession)
    shared = hosts.sparkSession.sparkContext.broadcast(build(rules))

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = shared.value
        for host, path in batches:
            won = [match(root, h, p) for h, p in zip(host, path)]
            yield pd.DataFrame({"rule": [r and r.text for r in won], "verdict": [r.verdict if r else default for r in won]}, dtype=object)
    return hosts.withColumn("won", judge("host", "path")).select("page_id", "host", "path", "won.rule", "won.verdict")


def by_join(hosts: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """For rule sets too large to broadcast; ``rules`` has columns verdict, host, path.

    Pages with the same host and path are judged once, so a host that holds many pages is no larger group than its distinct paths.
    """
    sizes = rules.groupBy("host").agg(F.sort_array(F.collect_set(F.length("path"))).alias("sizes"))
    asked = hosts.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = asked.select("host", "path", F.explode(suffixes).alias("at")).join(sizes.withColumnRenamed("host", "at"), "at")
    tried = tried.select("host", "path", "at", F.explode("sizes").alias("size")).where(F.length("path") >= F.col("size"))
    keyed = tried.withColumn("start", F.expr("left(path, size)"))
    ruled = rules.select(F.col("host").alias("at"), F.col("path").alias("start"), "verdict")
    strength = F.struct(F.size(F.split("at", r"\.")), F.length("start"), (F.col("verdict") == "block").cast("int"))
    won = keyed.join(ruled, ["at", "start"]).groupBy("host", "path").agg(F.max_by(F.struct(F.concat("at", "start").alias("rule"), "verdict"), strength).alias("won"))
    return hosts.join(won, ["host", "path"], "left").select("page_id", "host", "path", "won.rule", F.coalesce("won.verdict", F.lit(default)).alias("verdict"))


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", max_chars: int = MAX_CHARS) -> DataFrame:
    """Per page: page_id, host, path, the rule that decides (null if none) and the verdict."""
    host, path = host_and_path(F.col("url"))
    hosts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    if sum(len(r.text) for r in rules) <= max_chars:
        return by_trie(hosts, rules, default)
    frame = hosts.sparkSession.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    return by_join(hosts, frame.distinct(), default)
