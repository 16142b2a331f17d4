"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairlab.llm.arrow import stored

SALTS = 16


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the links: the smallest node it is joined to, directly or over others.

    Each round links every node's larger neighbours to the smallest node around it, then shortens the paths, until
    nothing changes: the number of rounds grows with the logarithm of the longest path. Rounds are written to the shared
    scratch folder; nothing but a change count reaches the driver. Null ends are left out.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # The hub of a large group is the end of many links: its rows are dealt over salts.
        up = both.where("v > u").withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        large = up.join(spread, ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .union(down.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = stored(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    ).groupBy("node").agg(F.min("root").alias("root"))
