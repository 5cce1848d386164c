"""Depth-bounded expansion of a link frontier over the page captures."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidings.operators import fetch
from tidings.operators.domains import SuffixRules
from tidings.session import cut_lineage


class Crawl(NamedTuple):
    """What a crawl leaves: every frontier row by depth, the content of captured pages, and (depth, pages_ok, pages_failed)."""

    frontier: DataFrame
    content: DataFrame
    counts: list[tuple[int, int, int]] | None = None


def crawl(
    seeds: DataFrame,
    captures: DataFrame,
    rules: SuffixRules,
    depth: int = 1,
    inside_domain: bool = True,
    remember: str = "all",
    counted: bool = False,
) -> Crawl:
    """Visit the seeds and follow links until ``depth`` levels are fetched.

    ``remember='all'`` never returns to a visited URL; ``remember='level'`` only skips URLs of
    the level just fetched, so deeper crawls may visit a page twice. Each new frontier holds
    URLs alone and is written to the shared folder: a level starts from stored rows however deep
    the crawl goes, and the HTML is read from the captures, never copied.

    ``counted`` stores the content as well and counts pages while levels and content are written, so that
    no join and no scan is made for the counters.
    """
    if remember not in ("all", "level"):
        raise ValueError("remember must be 'all' or 'level'")
    sizes: list[int] = []

    def stored(level: DataFrame) -> DataFrame:
        if not counted:
            return cut_lineage(level)
        out, seen = _observed(level, F.count(F.lit(1)).alias("n"))
        sizes.append(seen.get("n", 0))
        return out

    first = seeds.select("url", "seed_url", F.lit(0).alias("depth"))
    levels = [stored(first) if counted else first]
    for level in range(1, depth):
        current = levels[-1]
        visited = reduce(DataFrame.unionByName, levels) if remember == "all" else current
        links = fetch.page_links(fetch.captured(current, captures))
        following = fetch.next_frontier(links, visited, rules, inside_domain)
        levels.append(stored(following.withColumn("depth", F.lit(level))))
    frontier = reduce(DataFrame.unionByName, levels)
    content = fetch.page_content(frontier, captures)
    if not counted:
        return Crawl(frontier, content)
    content, found = _observed(content, *[F.count_if(F.col("depth") == d).alias(f"ok{d}") for d in range(depth)])
    return Crawl(frontier, content, [(d, found.get(f"ok{d}", 0), sizes[d] - found.get(f"ok{d}", 0)) for d in range(depth)])


def _observed(df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
    """The rows stored, and metrics taken while they were written: of each task's last attempt, once."""
    seen = Observation()
    return cut_lineage(df.observe(seen, *metrics)), seen.get
