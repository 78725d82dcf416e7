"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patina.llm.shared import stored

MAX_ROUNDS = 60  # far above the logarithm of any table; reaching it is an error


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie neighbours of each vertex to the least of them and itself.

    ``larger`` ties neighbours above the vertex, else the vertex and neighbours below it.
    """
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = edges.select(F.explode(ends).alias("e")).select("e.*")
    if not larger:
        both = both.where(F.col("v") < F.col("u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.where(F.col("v") > F.col("u")) if larger else both
    tied = F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
    # The least neighbour of a small star ties the vertex itself in place of its own loop.
    found = tied if larger else F.when(F.col("v") == F.col("m"), F.struct("u", F.col("m").alias("v"))).otherwise(tied)
    stars = joined.join(least, "u").select(found.alias("e")).select("e.*")
    return stars.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, component) of every vertex of ``edges`` (u, v); the component is its least vertex.

    Alternates large stars and small stars until every vertex hangs on the least of its
    component, which takes a logarithmic number of rounds. Each round adds up minima
    before it moves them and is written to shared storage. Loops and repeated edges do no
    harm; rows with a null end are left out. Vertices without edges are not in the result.
    """
    now = stored(edges.select("u", "v").where("u <> v").distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        # Stored in between, for each star reads its edges twice.
        now = stored(_stars(stored(_stars(now, larger=True)), larger=False))
        count, total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (count, total) == mark or not count:
            least = now.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()
            return now.select("u", F.col("v").alias("component")).unionByName(least)
        mark = (count, total)
    raise RuntimeError("connected components did not settle")
