"""Connected components of a link table by alternating large and small stars.

Each round links every node to the smallest node beside it (first its larger neighbours,
then its smaller ones) until the links form stars. A round is two aggregations and two
joins; the minima are written before they are joined back, so that both sides of a join
are plain shuffles, whose hot keys Spark splits. Nothing but row counts and checksums
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import stored


def _star(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` (u, v): each v is linked to the smallest of u and all its v."""
    low = stored(rows.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), label)
    return rows.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(links: DataFrame, left: str = "a", right: str = "b", max_rounds: int = 60) -> DataFrame:
    """``node``, ``component`` for every node that has a link; the smallest node names it.

    Links to itself and null ends are ignored; without links the result has no rows.
    """
    ends = links.where(F.col(left) != F.col(right))
    now = stored(ends.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct(), "links")
    seen = _fingerprint(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = stored(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links")
        large = stored(_star(both, "large").where("u > v").distinct(), "links")
        down = large.where("u > v")
        low = stored(down.groupBy("u").agg(F.min("v").alias("m")), "small")
        moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        now = stored(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _fingerprint(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("components did not settle")
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
