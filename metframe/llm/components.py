"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metframe.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); nodes of one component have the same root, one of them.

    The graph is contracted: each node goes over to the first of itself and its neighbours, in an order by hashes that is
    another one in each round, edges go over to what their ends became, and equal ones are merged. A star is gone after
    one round, a chain loses about half its nodes. Every round is a written table; the roots are handed back round by round.
    """
    edges = between(edges.select("a", "b"))
    nodes, rounds = edges.select(F.col("a").alias("node"), F.col("b").alias("root")), []
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), c).alias("h"), F.col(c).alias("to"))  # noqa: B023, E731
        ends = edges.union(edges.select("b", "a"))
        first = ends.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("near"))
        rounds.append(cut_lineage(first.select("node", F.least("near", order("node"))["to"].alias("root"))))
        edges = between(became(became(edges, rounds[-1], "a"), rounds[-1], "b"))
    if not rounds:
        return nodes.where("false")
    roots = rounds.pop()
    for before in reversed(rounds):
        roots = cut_lineage(became(before, roots, "root"))
    return roots


def became(df: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """The column's nodes replaced by their roots, if they have one."""
    named = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return df.join(named, df[name] == named["_node"], "left").withColumn(name, F.coalesce("_root", name)).drop("_node", "_root")


def between(edges: DataFrame) -> DataFrame:
    """Edges between different nodes, each once."""
    ends: list[Column] = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    return cut_lineage(edges.where("a <> b").select(*ends).distinct())
