"""Breadth-first search over a table of fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as X


def links(pages: DataFrame) -> DataFrame:
    """src, dst of absolute links in the pages' html, without fragments."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)<a\s[^>]*href\s*=\s*["']([^"'#]+)"""), F.lit(1))
    return pages.select(F.col("url").alias("src"), F.explode(found).alias("dst")).filter(F.col("dst").rlike("^https?://")).distinct()


def reached(pages: DataFrame, edges: DataFrame, seeds: list[str], depth: int, checkpoint, same_host: bool = True) -> DataFrame:
    """url, depth of pages within ``depth`` links of the seeds; rounds are as many as ``depth``,
    and each joins the frontier, not what was found before it, to the links."""
    if same_host:
        edges = edges.filter(X.host(F.col("src")) == X.host(F.col("dst")))
    edges = checkpoint(edges.join(pages.select(F.col("url").alias("dst")), "dst", "left_semi"))
    found = checkpoint(pages.filter(F.col("url").isin(seeds)).select("url", F.lit(0).alias("depth")).distinct())
    for k in range(1, depth + 1):
        frontier = found.filter(F.col("depth") == k - 1)
        new = edges.join(frontier.select(F.col("url").alias("src")), "src", "left_semi").select(F.col("dst").alias("url")).distinct()
        found = checkpoint(found.unionByName(new.join(found, "url", "left_anti").select("url", F.lit(k).alias("depth"))))
    return found
