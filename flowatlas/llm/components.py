"""Connected components of a link table, in a number of rounds near the logarithm of the longest chain."""

from pyspark.sql import DataFrame, functions as F

from flowatlas.llm.common import cut_lineage


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `links` (a, b); component is the smallest node reachable.

    Alternating stars: every node's larger neighbours, then its smaller ones, are linked to
    its smallest neighbour, until every link ends in a root. A node with very many links is
    reduced to one value for each task before anything is shuffled by it, and its links are
    split over tasks where they meet that value. Rows with a null end and loops count for
    nothing; a link may be given more than once and either way round.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut_lineage(edges.filter("a > b").distinct())
    for _ in range(max_rounds):
        small = cut_lineage(_star(edges, both_ways=True))
        new = cut_lineage(_star(small, both_ways=False).distinct())
        changed = new.exceptAll(edges).limit(1).count()
        edges = new
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star step; with `both_ways` each node looks at all neighbours, else at smaller ones."""
    near = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if both_ways:
        near = near.unionAll(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = near.groupBy("node").agg(F.min("other").alias("least"))
    least = least.withColumn("least", F.least("node", "least")) if both_ways else least
    # as a table, so that both sides of the join are plain and Spark can split a hot node's links
    least = cut_lineage(least)
    joined = near.join(least, "node")
    if both_ways:
        out = joined.filter("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("other").alias("a"), F.col("least").alias("b")).unionAll(
            least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
    return out.filter("a > b")
