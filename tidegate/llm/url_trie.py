"""URL filters: a broadcast trie over reversed host labels, then path segments.

A rule fits its host and all subdomains if the url's path starts with the rule's path. Of the
rules that fit, the one with most host labels wins, then the one with the longest path; of equal
(host, path) the block rule. Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z
lower-cased, in rules as well; path: from there up to `?`, `#` or the end. A null url or one without
`://` has both empty and fits no rule but one of an empty host. Urls without a fitting rule get the
default. Each row is judged on its own: repeated rows get the same verdict each, an empty table
gives no rows, and other columns, whatever their names, are returned only if `keep` names them (it
may not name host, path, rule or verdict).
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLDED = str.maketrans(UPPER, UPPER.lower())
MAX_BYTES = 32 << 20  # hosts and paths beyond this are refused, as the trie is broadcast


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    def __post_init__(self) -> None:
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"a verdict is allow or block, not {self.verdict!r}")


def build(rules: list[Rule]) -> dict:
    """Nested nodes: `labels` and `segments` lead on, `ends` holds what the last, open path
    segment must start with, and `sizes` the lengths of these, longest first."""
    size = sum(len((rule.host + rule.path).encode()) for rule in rules)
    if size > MAX_BYTES:
        raise ValueError(f"{size} bytes of rules; at most {MAX_BYTES} fit a broadcast trie")
    root: dict = {"labels": {}, "paths": None}
    for rule in rules:
        node, host = root, rule.host.translate(FOLDED)
        for label in reversed(host.split(".")) if host else ():
            node = node["labels"].setdefault(label, {"labels": {}, "paths": None})
        node["paths"] = node["paths"] or _path_node()
        node = node["paths"]
        *whole, open_end = rule.path.split("/")
        for segment in whole:
            node = node["segments"].setdefault(segment, _path_node())
        if node["ends"].get(open_end, (None, "allow"))[1] != "block":
            node["ends"][open_end] = (host + rule.path, rule.verdict)
        if len(open_end) not in node["sizes"]:
            node["sizes"] = sorted([*node["sizes"], len(open_end)], reverse=True)
    return root


def _path_node() -> dict:
    return {"segments": {}, "ends": {}, "sizes": []}


def _on_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
    best = None
    for i, segment in enumerate(segments):
        for size in node["sizes"]:
            found = node["ends"].get(segment[:size]) if size <= len(segment) else None
            if found is not None:
                best = found
                break
        node = node["segments"].get(segment) if i + 1 < len(segments) else None
        if node is None:
            break
    return best


def lookup(root: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits."""
    segments, node, best = path.split("/"), root, None
    if root["paths"]:
        best = _on_path(root["paths"], segments)
    for label in reversed(host.split(".")) if host else ():
        node = node["labels"].get(label)
        if node is None:
            break
        if node["paths"]:
            best = _on_path(node["paths"], segments) or best
    return best


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def judge(spark: SparkSession, host: Column, path: Column, rules: list[Rule],
          default: str = "allow") -> Column:
    """Struct (rule, verdict) for host and path; rule is null where the default decides."""
    trie = spark.sparkContext.broadcast(build(rules))

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def of(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = [lookup(trie.value, h, p) or (None, default)
                 for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], ["rule", "verdict"])
    return of(host, path)


def filter_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url",
                keep: tuple[str, ...] = (), default: str = "allow") -> DataFrame:
    """The columns `keep`, then host, path, rule and verdict of each url."""
    own = pages.select(*keep, url_host(F.col(url_col)).alias("host"),
                       url_path(F.col(url_col)).alias("path"))
    judged = judge(pages.sparkSession, F.col("host"), F.col("path"), rules, default)
    return (own.withColumn("_judged", judged)
            .select(*keep, "host", "path", "_judged.rule", "_judged.verdict"))
