"""Connected components: of a link table by alternating large-star and small-star, and of arrays in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import materialise


def _toward_least(links: DataFrame) -> DataFrame:
    """Links (x, y) with, for each, ``least``: the least of x and all its y.

    The least ids are written first, so that the join reads plain shuffles and
    the links of a large group's centre, which is one x, can be split.
    """
    least = links.groupBy("x").agg(F.min("y").alias("least")).withColumn("least", F.least("x", "least"))
    return links.join(materialise(least, "least"), "x")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    return _toward_least(both).filter("y > x").select(F.col("y").alias("x"), F.col("least").alias("y")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    to = _toward_least(down)
    moved = to.select(F.col("y").alias("x"), F.col("least").alias("y"))
    return moved.unionByName(to.select("x", F.col("least").alias("y"))).filter("x <> y").distinct()


def components(links: DataFrame) -> DataFrame:
    """(x, y) links of long ids to (x, y) with y the least id that x reaches; ids without links and least ids have no row.

    Each round is written to the shared folder; only a count and a checksum of
    the links reach the driver.
    """
    now = materialise(links.filter("x <> y").select("x", "y").distinct(), "links")
    mark = _mark(now)
    while True:
        after = materialise(_small_star(_large_star(now)), "links")
        seen = _mark(after)
        if seen == mark:
            return after
        now, mark = after, seen


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least place reachable from each of n places."""
    parent = np.arange(n)
    for a, b in links:
        while True:
            ra, rb = parent[a], parent[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            low, high = np.minimum(ra[open_], rb[open_]), np.maximum(ra[open_], rb[open_])
            np.minimum.at(parent, high, low)
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
    return parent
