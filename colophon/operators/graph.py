"""Graph operators: merge chains by a recursive query, components and reachability by steps over written edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.sources.tables import many, written


def resolve_chains(nodes: DataFrame) -> DataFrame:
    """GR-01: id, target, hops, cyclic of nodes (id, into): merge pointers followed to a node without one.

    A pointer to itself is ignored. A chain that comes back to one of its nodes is cyclic, and a pointer to a missing node has
    that node as its target; both are for a gate to reject.
    """
    spark = nodes.sparkSession
    return spark.sql(
        """
        WITH RECURSIVE e AS (SELECT id, CASE WHEN into <> id THEN into END AS into FROM {nodes}),
        walk(id, now, path, cyclic) AS (
          SELECT id, id, array(id), false FROM e
          UNION ALL
          SELECT w.id, e.into, array_append(w.path, e.into), array_contains(w.path, e.into)
          FROM walk w JOIN e ON e.id = w.now WHERE e.into IS NOT NULL AND NOT w.cyclic)
        SELECT w.id, w.now AS target, size(w.path) - 1L AS hops, w.cyclic
        FROM walk w LEFT ANTI JOIN (SELECT id FROM e WHERE into IS NOT NULL) m ON m.id = w.now AND NOT w.cyclic
        """,
        nodes=nodes,
    )


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node, root: for each node of the edges (a, b) the least node that it is connected with; nodes are of any type with an order.

    Alternating steps: a node's larger neighbours go to the least of the node and its neighbours, then a node and its smaller
    neighbours go to the least of these. Each step is written to the shared folder, so that the plan doesn't grow and a lost
    executor costs one step; the steps grow with the logarithm of a chain's length, not with the length.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    last = None
    for _ in range(most):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(many(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(many(below), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(near.unionByName(below.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "stars")
        got = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if got == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = got
    raise RuntimeError("components did not settle")


def reached(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """GR-03: group, n_members, n_reached: members (group, member) that edges (group, a, b), either way, connect to the least one.

    The edges of all groups are followed together; no group is collected, so groups may have any number of members.
    """
    members = nodes.select("group", "member").distinct()
    at = lambda c: F.struct(F.col("group").alias("group"), F.col(c).alias("member"))
    roots = components(edges.select(at("a").alias("a"), at("b").alias("b")))
    # a component that has the least member has it as its root
    per_root = roots.groupBy("root").agg((F.count("*") + 1).alias("n")).select("root.group", "root.member", "n")
    sizes = members.groupBy("group").agg(F.count("*").alias("n_members"), F.min("member").alias("member"))
    return sizes.join(many(per_root), ["group", "member"], "left").select("group", "n_members", F.coalesce("n", F.lit(1)).alias("n_reached"))
