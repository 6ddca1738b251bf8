"""Connected components of an edge table, distributed.

Alternating large-star and small-star passes (Kiveris et al., 2014). Every pass is two aggregations with
map-side combining and joins that adaptive execution may split, so a hub costs no single task; lineage is cut
by written tables, which survive lost executors. Nothing but a convergence checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v). Large: neighbours above u go to the least of u and its neighbours; small: those below."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """(u, v) long pairs -> (node, root), root the least node of the component; only nodes with an edge appear."""

    def sign(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = scratch.write(edges.select("u", "v").where("u <> v").distinct(), "edges0")
    before = sign(now)
    for k in range(1, most_rounds + 1):
        after = scratch.write(_star(_star(now, True), False), f"edges{k}")
        scratch.drop(f"edges{k - 1}")
        now, old, before = after, before, sign(after)
        if before == old:
            break
    else:
        raise RuntimeError("components did not converge")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
