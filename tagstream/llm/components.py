"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.runtime import checkpointed

# Few links are few tasks: a round's shuffles start from as many partitions as its links need.
LINKS_PER_PARTITION = 200_000


def _distinct_links(df: DataFrame) -> DataFrame:
    return df.filter("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return _distinct_links(
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest one; a is the larger end."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    joined = links.join(least, "a")
    return _distinct_links(
        joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    )


def components(links: DataFrame) -> DataFrame:
    """``node, root`` with the smallest reachable node, for every node but the roots themselves.

    ``links`` has two bigint columns ``a`` and ``b``. Alternating stars: each round is a
    minimum per node, reduced before the shuffle, and a join in which adaptive execution can
    split a node of many links; the number of rounds grows with the logarithm of the longest
    path. Every round is checkpointed, so a lost executor repeats one round at most.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    links = checkpointed(_distinct_links(links.select(larger.alias("a"), smaller.alias("b"))))
    mark = _mark(links)
    while mark[0]:
        parts = mark[0] // LINKS_PER_PARTITION + 1
        links = checkpointed(_small_star(_large_star(links.coalesce(parts)).coalesce(parts)))
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(links: DataFrame) -> tuple:
    """Changes whenever the set of links does."""
    code = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(code), F.sum(code.cast("decimal(38,0)"))).first())
