"""Connected components of a graph given as a table of edges, by large and small stars.

In a large-star step every node links its larger neighbours to the least node it sees; in a
small-star step it links its smaller neighbours and itself to that node. Both are a minimum by
node and a join on the node; nothing collects a neighbourhood, so a node of any degree will
do. Once neither step changes an edge, every node is linked to the least one it can reach.
"""

from pyspark.sql import DataFrame, functions as F

from spanwatch.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """Each node (u) of directed edges u -> v with the least of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select(
        F.col("u").alias("_u"), F.least("u", "least").alias("least")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_least(both), F.col("u") == F.col("_u"))
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node (u) to the smaller one (v)."""
    joined = edges.join(_least(edges), F.col("u") == F.col("_u"))
    moved = joined.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = joined.select("u", F.col("least").alias("v"))
    return moved.unionAll(own).distinct()


def _mark(edges: DataFrame) -> tuple:
    """What does not change only if no edge does: their number and two sums over them."""
    hashes = F.xxhash64("u", "v")
    row = edges.agg(
        F.count("*"),
        F.sum(F.pmod(hashes, F.lit(1_000_003))),
        F.sum(F.pmod(F.xxhash64(hashes), F.lit(999_983))),
    ).first()
    return tuple(row)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node in `edges` (columns a and b, any order, repeats allowed).

    The component is the least node that can be reached. Nodes without an edge are not listed.
    Each round is written to the shared folder.
    """
    now = stored(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    for _ in range(most_rounds):
        if mark[0] == 0:
            break
        now = stored(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
