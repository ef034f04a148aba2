"""Operator 10: URL filters by a sort-merge range join.

A host is reversed label by label and closed with a dot (``a.example.net`` ->
``net.example.a.``).  In that canonical order a rule's host and all of its
subdomains are one interval ``[key, key with its last dot raised)``, and
intervals nest or are disjoint.  URLs are cut into ranges of (key, path, id), so
a host that holds a third of all rows spans many ranges; each rule goes to the
ranges its interval meets.  A sorted sweep over a range keeps the stack of rules
whose intervals are open and asks the open hosts for their longest path prefix.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import ascii_lower, shuffle_parts, table

#: Rules of the registered query: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def reversed_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def _sort_key(key: str, path: str, row: int) -> str:
    return f"{key}\0{path}\0{row:020d}"


def _place_urls(bounds: list[str]):
    def run(batches):
        for b in batches:
            hosts, paths, rows = (b.column(c).to_pylist() for c in ("host", "path", "_row"))
            keys = [reversed_key(h) for h in hosts]
            at = [bisect.bisect_right(bounds, _sort_key(*x)) for x in zip(keys, paths, rows)]
            n = len(at)
            yield pa.RecordBatch.from_pydict({
                "_range": pa.array(at, pa.int32()), "_key": pa.array(keys, pa.string()),
                "_kind": pa.array([1] * n, pa.int32()), "page_id": b.column("page_id"), "host": b.column("host"),
                "path": b.column("path"), "rule": pa.nulls(n, pa.string()), "verdict": pa.nulls(n, pa.string())})
    return run


def _place_rules(bounds: list[str]):
    def run(batches):
        for b in batches:
            cols = {c: [] for c in ("_range", "_key", "_kind", "page_id", "host", "path", "rule", "verdict")}
            for host, path, verdict in zip(*(b.column(c).to_pylist() for c in ("host", "path", "verdict"))):
                if host is None or path is None or verdict is None:
                    continue
                key = reversed_key(host)
                first, last = bisect.bisect_right(bounds, key), bisect.bisect_left(bounds, key[:-1] + "/")
                for r in range(first, last + 1):
                    for c, v in zip(cols, (r, key, 0, None, host, path, host + path, verdict)):
                        cols[c].append(v)
            yield pa.RecordBatch.from_pydict({c: pa.array(v, _TYPES[c]) for c, v in cols.items()})
    return run


_TYPES = {"_range": pa.int32(), "_key": pa.string(), "_kind": pa.int32(), "page_id": pa.int64(), "host": pa.string(),
          "path": pa.string(), "rule": pa.string(), "verdict": pa.string()}
_PLACED = "_range int, _key string, _kind int, page_id long, host string, path string, rule string, verdict string"


class _Open:
    """The rules of one open host: by path, with the lengths in use."""

    def __init__(self, key: str):
        self.key, self.rules, self.lengths = key, {}, []

    def add(self, path: str, rule: str, verdict: str) -> None:
        old = self.rules.get(path)
        if old is None:
            if len(path) not in self.lengths:
                bisect.insort(self.lengths, len(path))
        elif old[1] <= verdict:  # one rule twice: allow comes before block
            return
        self.rules[path] = (rule, verdict)

    def find(self, path: str) -> tuple[str, str] | None:
        for n in reversed(self.lengths):
            if n <= len(path) and (hit := self.rules.get(path[:n])):
                return hit
        return None


def _sweep(default: str):
    def run(batches):
        stack: list[_Open] = []
        at = None
        for b in batches:
            rule_out, verdict_out, keep = [], [], []
            cols = [b.column(c).to_pylist() for c in ("_range", "_key", "_kind", "path", "rule", "verdict")]
            for i, (here, key, kind, path, rule, verdict) in enumerate(zip(*cols)):
                if here != at:
                    stack, at = [], here
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Open(key))
                    stack[-1].add(path, rule, verdict)
                    continue
                best = None
                for o in reversed(stack):  # the most specific host first, so it wins among equal lengths
                    hit = o.find(path)
                    if hit and (best is None or len(hit[0]) > len(best[0])):
                        best = hit
                keep.append(i)
                rule_out.append(best[0] if best else None)
                verdict_out.append(best[1] if best else default)
            got = b.select(["page_id", "host", "path"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*got.columns, pa.array(rule_out, pa.string()), pa.array(verdict_out, pa.string())],
                                             names=["page_id", "host", "path", "rule", "verdict"])
    return run


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``.

    ``rules`` has host, path and verdict.  A rule fits its host and all
    subdomains where the URL's path starts with the rule's path; the longest
    ``host + path`` wins (of equally long ones, the longer host).  Null URLs and
    URLs without ``://`` have empty host and path and meet no rule.  Repeated
    rows stay, ids may be null, a rule with a null part is void, of one rule given
    twice "allow" is taken, and empty tables give no rows or default verdicts.
    """
    spark = pages.sparkSession
    part = [F.coalesce(F.regexp_extract(url_col, _PARTS, i), F.lit("")) for i in (1, 2)]
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), ascii_lower(part[0]).alias("host"), part[1].alias("path"))
    urls = urls.withColumn("_row", F.coalesce(F.col("page_id"), F.lit(0)))
    ranges, n = 4 * shuffle_parts(spark), pages.count()
    # The sample only places the cuts between ranges; any cuts give the same result.
    picked = urls.where(F.rand(17) < F.lit(min(1.0, 24.0 * ranges / max(n, 1)))).select("host", "path", "_row").collect()
    keys = sorted(_sort_key(reversed_key(r.host), r.path, r._row) for r in picked)
    bounds = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    placed = urls.mapInArrow(_place_urls(bounds), _PLACED)
    rules = rules.select(F.regexp_replace(ascii_lower(F.col("host")), r"\.+$", "").alias("host"), "path", "verdict")
    both = placed.unionByName(rules.mapInArrow(_place_rules(bounds), _PLACED))
    swept = both.repartition(shuffle_parts(spark), "_range").sortWithinPartitions("_range", "_key", "_kind")
    return swept.mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN NULL
                       ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, lower(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1)) AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
