"""URL filter: a trie over reversed host labels and path segments, longest match wins.

A rule is a host and the start of a path, like ``example.org/en/``. It fits its host and all subdomains, if the path of the
url starts with that of the rule. Of several rules that fit, the one with more host labels wins, then the longer path;
allow wins over block for the same host and path. Without a rule the default holds.

The trie is built once on the driver from at most ``max_rules`` rules, and broadcast; its walk is a step per label and path
segment. A longer list of rules is not broadcast: urls are then joined with the rules on host and path start, with the
same result, and adaptive execution splits hot hosts.

Defined results: a NULL url, and one without ``://``, has an empty host and path and fits no rule; a rule without a host or
with an unknown verdict is refused; rules that repeat count once; an empty table or no rules are allowed. Hosts are
compared as they stand, A-Z lower-cased; ports and user names are part of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii

VERDICTS = ("allow", "block")


@dataclass
class Node:
    """A label or segment: the rules that end here, by the rest of the path, and what follows."""

    labels: dict[str, Node] = field(default_factory=dict)
    segments: dict[str, Node] = field(default_factory=dict)
    #: starts of the next segment, longest first, with rule and verdict; the empty start ends at this segment
    ends: list[tuple[str, str, str]] = field(default_factory=list)


def split_rule(rule: str) -> tuple[str, str]:
    """Host in lower case, and path from its first slash on."""
    host, slash, rest = rule.partition("/")
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), slash + rest


def checked(rules: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[str, str]]:
    """(host, path) to (rule, verdict)."""
    out: dict[tuple[str, str], tuple[str, str]] = {}
    for verdict, rule in rules:
        host, path = split_rule(rule)
        if verdict not in VERDICTS or not host:
            raise ValueError(f"not a rule: {verdict} {rule}")
        if out.get((host, path), ("", "block"))[1] == "block":
            out[host, path] = (rule, verdict)
    return out


def build_trie(rules: list[tuple[str, str]]) -> Node:
    top = Node()
    for (host, path), (rule, verdict) in checked(rules).items():
        node = top
        for label in reversed(host.split(".")):
            node = node.labels.setdefault(label, Node())
        *whole, last = path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        node.ends.append((last, rule, verdict))
        node.ends.sort(key=lambda end: -len(end[0]))
    return top


def _on_path(node: Node, segments: list[str]) -> tuple[str, str] | None:
    """The rule with the longest path below a host."""
    best = None
    for i, segment in enumerate(segments):
        for start, rule, verdict in node.ends:
            if segment.startswith(start):
                best = rule, verdict
                break
        if i + 1 == len(segments) or segment not in node.segments:
            break
        node = node.segments[segment]
    return best


def match(top: Node, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest match."""
    best, node, segments = None, top, path.split("/")
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        best = _on_path(node, segments) or best
    return best


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for NULL or without ``://``."""
    raw = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(raw, r"(?s)^.*?://(.*)$", 1)
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def _by_trie(spark: SparkSession, parts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    shared = spark.sparkContext.broadcast(build_trie(rules))

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def lookup(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        top = shared.value
        found = [match(top, h, p) or (None, None) for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([x[i] for x in found], type=pa.string()) for i in (0, 1)], ["rule", "verdict"]
        )

    return parts.withColumn("m", lookup("host", "path")).select(*parts.columns, "m.rule", "m.verdict")


def _by_join(spark: SparkSession, parts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Each distinct (host, path) with the rules on one of its host endings and path starts."""
    known = [(h, p, r, v, h.count("."), len(p)) for (h, p), (r, v) in checked(rules).items()]
    table = spark.createDataFrame(known, "r_host string, r_path string, rule string, verdict string, labels int, length int")
    labels = F.split("host", r"\.")
    n = F.size(labels)
    hosts = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    starts = F.transform(F.sequence(F.lit(0), F.length("path")), lambda i: F.substring("path", F.lit(1), i))
    urls = parts.select("host", "path").distinct()
    keys = urls.withColumn("r_host", F.explode(hosts)).withColumn("r_path", F.explode(starts))
    best = F.max_by(F.struct("rule", "verdict"), F.struct("labels", "length")).alias("m")
    found = keys.join(table, ["r_host", "r_path"]).groupBy("host", "path").agg(best)
    return parts.join(found, ["host", "path"], "left").select(*parts.columns, "m.rule", "m.verdict")


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", id_col: str = "page_id", default: str = "allow",
    max_rules: int = 200_000,
) -> DataFrame:
    """One row per page: id, host, path, rule (NULL if none fits) and verdict. ``rules`` are (verdict, rule)."""
    host, path = url_parts(pages[url])
    parts = pages.select(pages[id_col].alias("id"), host.alias("host"), path.alias("path"))
    way = _by_trie if len(rules) <= max_rules else _by_join
    return way(pages.sparkSession, parts, rules).select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
