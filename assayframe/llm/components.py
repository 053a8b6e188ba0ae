"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import folders


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) to (node, root): the smallest node of the component of every linked node but the root itself.

    Every step is an aggregate and a join on one endpoint, written to the shared folder; the links of one node (a pair of
    16-byte names each) meet in one task of the join. Links of a node to itself and repeated links are ignored, null nodes must not occur.
    """
    ab = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, before = folders.save(ab, "edges"), None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = folders.save(large, "edges")
        least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("k"))
        moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = folders.save(moved.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
