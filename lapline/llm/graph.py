"""Connected components of a link table, in rounds of grouped minima (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm._common import cut


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """``node``, ``root`` for every node that a link joins to another; ``root`` is the smallest node reachable.

    Links with a null end, self-links and repeats count for nothing.  A round replaces the links of every node by
    links to the smallest of its neighbourhood, so that long chains halve; hubs are met by partial minima and a
    join that Spark may split, never by gathering a neighbourhood.  Each round is cut to the shared folder.
    """
    x, y = F.col(a), F.col(b)
    edges = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"), x.isNotNull().alias("x"), y.isNotNull().alias("y"))
    edges = cut(edges.filter("x AND y AND u != v").select("u", "v").distinct())
    mark = None
    for _ in range(max_rounds):
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if (state["n"], state["h"]) == mark or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        mark = (state["n"], state["h"])
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(smallest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(moved.union(smallest.select("u", F.col("m").alias("v"))).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
