"""Operator 10: URL filters by a sort-merge range join.

A host's labels reversed and each closed by a dot ("blog.example.com" -> "com.example.blog.")
turn a rule's host with all its subdomains into one interval of sorted keys, and intervals
of hosts nest.  Pages and rules are dealt into ranges of keys, a rule into each range that
its interval meets; one sorted sweep per range keeps a stack of the active nested rules.
Of the active rules whose path begins the page's path, the longest (host and path together;
then the longer host) wins.  Without one the verdict is ``allow``.

Range ends come from a bounded sample of sort keys, which decides only where rows go; the
key goes on with path and page_id, so a host or URL with any share of the rows is dealt out.

Defined results: a null url, or one without ``://``, has empty host and path; of equal rules
with different verdicts ``block`` wins; a rule without a host fits every url; repeated rows
give repeated results; empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import pick, tidy

#: Fixed values of the contract.
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
SAMPLE_PER_RANGE = 40
KEY_CHARS = 200  # of a range's end; the rest cannot matter for dealing rows

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OUT = "page_id long, host string, path string, rule string, verdict string"
_ROW = "part int, key string, kind int, path string, page_id long, host string, verdict string"


def _host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", "")).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_replace(after, r"(?s)[/?#].*\z", ""), _UPPER, _LOWER)
    path = F.when(after.rlike(r"\A[^/?#]*/"), F.regexp_replace(F.regexp_replace(after, r"\A[^/?#]*", ""), r"(?s)[?#].*\z", "")).otherwise("")
    return host, path


def _key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def apply_rules(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every page (page_id, url); ``rules``: host,
    path, verdict."""
    spark = pages.sparkSession
    host, path = _host_and_path(F.col("url"))
    p = pick(pages, "page_id", "url").select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")).withColumn("key", _key(F.col("host")))
    r = pick(rules, "host", "path", "verdict").select(F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").withColumn("key", _key(F.col("host")))

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = p.count()
    sample = p.sample(fraction=min(1.0, SAMPLE_PER_RANGE * ranges / max(n, 1)), seed=7).select(F.substring("key", 1, KEY_CHARS), F.substring("path", 1, KEY_CHARS), F.coalesce("page_id", F.lit(0))).collect()
    keys = sorted(tuple(x) for x in sample)
    ends = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = [bisect_right(ends, (k, q, i or 0)) for k, q, i in zip(b["key"].to_pylist(), b["path"].to_pylist(), b["page_id"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), b["key"], pa.array([1] * len(part), pa.int32()), b["path"], b["page_id"], b["host"], pa.nulls(len(part), pa.string())], ["part", "key", "kind", "path", "page_id", "host", "verdict"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, q, h, v in zip(b["key"].to_pylist(), b["path"].to_pylist(), b["host"].to_pylist(), b["verdict"].to_pylist(), strict=True):
                first = bisect_right(ends, (k, "", -(1 << 63)))
                last = bisect_left(ends, (k[:-1] + "/", "", -(1 << 63))) if k else len(ends)  # "/" follows "."
                rows += [(part, k, 0, q, None, h, v) for part in range(first, last + 1)]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["part", "key", "kind", "path", "page_id", "host", "verdict"])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stack = None, []  # of (key, host, {path: verdict}, lengths of paths, longest first)
        for b in batches:
            out = []
            for part, key, kind, path, page, host, verdict in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part != now:
                    now, stack = part, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, []))
                    paths, sizes = stack[-1][2:]
                    if paths.get(path) != "block":
                        paths[path] = verdict
                    if len(path) not in sizes:
                        sizes.append(len(path))
                        sizes.sort(reverse=True)
                    continue
                best = None
                for _, rule_host, paths, sizes in stack:
                    size = next((s for s in sizes if path[:s] in paths), None)
                    if size is not None and (best is None or (len(rule_host) + size, len(rule_host)) > best[0]):
                        best = ((len(rule_host) + size, len(rule_host)), rule_host + path[:size], paths[path[:size]])
                out.append((page, host, path, best[1] if best else None, best[2] if best else default))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i else pa.int64()) for i, c in enumerate(columns)], ["page_id", "host", "path", "rule", "verdict"])

    rows = p.mapInArrow(tidy(deal), _ROW).unionByName(r.mapInArrow(tidy(spread), _ROW))
    rows = rows.repartitionById(len(ends) + 1, F.col("part")).sortWithinPartitions("part", "key", "kind", "path", "page_id")
    return rows.mapInArrow(tidy(sweep), _OUT)


ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(a, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(a, ''), '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
r(h, q, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
m AS (SELECT page_id, max_by(h || q, length(h || q)) AS rule, max_by(v, length(h || q)) AS v FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m ON m.page_id = p.page_id
"""
