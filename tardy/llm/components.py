"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a minimum per vertex (partially aggregated before its shuffle) and a join back to
the edges, so a vertex with very many edges is never gathered in one task. Edges and labels stay
distributed; each round is written to the shared checkpoint folder, and the driver sees a count
and a checksum only.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tardy.llm.common import by_shuffle, stored

MAX_ROUNDS = 60
EDGES_AT_ONCE = 2000          # of a partition: few edges go into few partitions, as a round is many short stages


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition(parts, "u")
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(by_shuffle(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u != v")


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    edges = edges.repartition(parts, "u").distinct()
    low = edges.groupBy("u").agg(F.min("v").alias("m"))       # every edge points down: u > v
    moved = edges.join(by_shuffle(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).repartition(parts, "u").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has an edge (u, v).

    Repeated edges, loops and both directions are fine; ids that only meet themselves are left
    out, and so are edges with a null end. An empty table gives an empty result.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.filter("u != v").distinct(), "edges")
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before, parts = None, min(most, 4 + edges.count() // EDGES_AT_ONCE)
    for _ in range(MAX_ROUNDS):
        edges = stored(_small_star(_large_star(edges, parts), parts), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return stars.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before = tuple(now)
    raise RuntimeError("components did not settle")
