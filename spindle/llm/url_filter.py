"""URL filters: a trie over reversed host labels, then path segments.

The rules are compiled into one trie that every task gets by broadcast (the
number of rules is checked against ``max_rules``; more are dealt into
several tries that are walked one after another, so no rule is dropped).
Walking a URL costs its labels and segments, not the number of rules.

Edge cases: a null url or one without ``://`` has an empty host and path,
fits no rule and gets the verdict of ``no_host``.  A url that no rule fits
gets ``default``.  A path that is empty does not start with ``/``.  Equal
rules with both actions: block wins.  An empty table gives an empty result;
repeated rows are judged one by one; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from spindle.llm.common import map_text
from spindle.llm.registry import query
from spindle.session import read_table

END = "\0"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rule list of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path, both empty if there is no ``://``."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    low = host if host.isascii() else None
    host = low.lower() if low is not None else "".join(c.lower() if c.isascii() else c for c in host)
    return host, slash + path


def build_trie(rules) -> dict:
    """Nested dicts: host labels from the right, then below ``END`` the path's
    whole segments, then below ``END`` the beginnings of a last segment."""
    root: dict = {}
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(END, {})
        *whole, last = rule.path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(END, {})
        if ends.get(last, ("", "allow"))[1] != "block":
            ends[last] = (rule.name, rule.action)
    return root


def find_rule(trie: dict, host: str, path: str) -> tuple[tuple[int, int], tuple[str, str]] | None:
    """The longest fitting rule: most host labels, then the longest path."""
    best = None
    node, depth = trie, 0
    segments = path.split("/")
    for label in reversed(host.split(".")) if host else ():
        node = node.get(label)
        if node is None:
            break
        depth += 1
        at, length = node.get(END), 0
        for segment in segments:
            if at is None:
                break
            for start, found in at.get(END, {}).items():
                rank = (depth, length + len(start))
                if segment.startswith(start) and (best is None or rank > best[0]):
                    best = rank, found
            at = at.get(segment)
            length += len(segment) + 1
    return best


def judge_urls(pages: DataFrame, rules=RULES, *, url: str = "url", keep: tuple[str, ...] = ("page_id",),
               default: str = "allow", no_host: str = "block", max_rules: int = 200_000) -> DataFrame:
    """host, path, rule and verdict of each row of ``pages``."""
    spark = pages.sparkSession
    rules = list(rules)
    tries = [spark.sparkContext.broadcast(build_trie(rules[i:i + max_rules]))
             for i in range(0, max(1, len(rules)), max_rules)]

    def make():
        parts = [t.value for t in tries]

        def judge(urls: pa.Array):
            out = []
            for u in urls.to_pylist():
                host, path = split_url(u)
                found = [b for b in (find_rule(t, host, path) for t in parts) if b]
                name, verdict = max(found, key=lambda b: (b[0], b[1][1] == "block"))[1] if found else (None, default if host else no_host)
                out.append((host, path, name, verdict))
            return [pa.array([r[i] for r in out], pa.string()) for i in range(4)]

        return judge

    fields = [T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict")]
    return map_text(pages, fields, make, column=url, keep=keep)


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path FROM u
), r(action, h, pre) AS (
  VALUES ('allow','com','/'), ('block','example.com','/en/'), ('allow','www.example.com','/en/'), ('block','net','/es/'), ('block','net','/fr/')
), m AS (
  SELECT p.*, h || pre AS rule, action,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(h) + length(pre) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (p.host = h OR p.host LIKE '%.' || h) AND starts_with(p.path, pre)
)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM m WHERE k = 1
"""


@query("op6_url_filters", ORACLE)
def op6_url_filters(spark, sf_dir):
    return judge_urls(read_table(spark, sf_dir, "pages"))
