"""Weighted hierarchies whose nodes may have several parents: pruning, cycles, longest-path depth.

Depth is the number of edges on the longest path from a node without parents. A path must not run
in circles, so edges that close one are cut first, by a rule that does not depend on any order of
visit: *within a strongly connected component, edges that do not go up in the order of node names are
cut*. What is left is acyclic, and its layers are peeled: the nodes without parents are layer 0,
without these layer 1, and so on. A round is a few joins on node names and a written table; rounds
grow with the depth (for chains of thousands of single parents ``graphs.tree_depths`` doubles pointers
instead).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexicarium.operators.tables import cut, drop, folder


def pruned_hierarchy(edges: DataFrame, register: DataFrame | None = None, least: int = 1, per_parent: int | None = None, most: int | None = None) -> DataFrame:
    """(parent, child, weight) of edges whose ends are both registered: no self-loops, weight of at least ``least``, repeated edges with their largest weight, then the ``per_parent`` heaviest of a parent and the ``most`` heaviest of all (equal weights by name)."""
    used = registered_edges(edges, register).where(F.col("parent") != F.col("child")).where(F.col("weight") >= least)
    once = used.groupBy("parent", "child").agg(F.max("weight").alias("weight"))
    if per_parent is not None:
        rank = F.row_number().over(Window.partitionBy("parent").orderBy(F.desc("weight"), "child"))
        once = once.withColumn("r_", rank).where(F.col("r_") <= per_parent).drop("r_")
    return once.orderBy(F.desc("weight"), "parent", "child").limit(most) if most is not None else once


def registered_edges(edges: DataFrame, register: DataFrame | None) -> DataFrame:
    """(parent, child, weight) of the edges whose ends are both registered (``node``); a missing weight counts 1."""
    used = edges.where("parent is not null and child is not null").select("parent", "child", F.coalesce("weight", F.lit(1)).alias("weight"))
    if register is None:
        return used
    nodes = register.select("node").distinct()
    return used.join(nodes.withColumnRenamed("node", "parent"), "parent", "left_semi").join(nodes.withColumnRenamed("node", "child"), "child", "left_semi")


def _fixpoint(step, state: DataFrame, path: str) -> tuple[DataFrame, str]:
    """Apply step to a written table until no row says ``moved``."""
    while True:
        new, new_path = cut(step(state))
        drop(state.sparkSession, path)
        state, path = new, new_path
        if state.where("moved").isEmpty():
            return state, path


def strong_components(edges: DataFrame) -> DataFrame:
    """(node, component) of nodes that lie on a cycle; component is its greatest node name.

    The greatest name that reaches a node colours it; what reaches that name within its colour is a component.
    Components found leave, and the rest is coloured anew. The result is a written table.
    """
    spark = edges.sparkSession
    left, left_path = cut(edges.where("parent <> child").select("parent", "child").distinct())
    found_path = f"{folder(spark)}/lexicarium/components-{left_path.rsplit('-', 1)[-1]}"
    spark.createDataFrame([], left.selectExpr("parent as node", "parent as component").schema).write.parquet(found_path)
    while not left.isEmpty():
        nodes = left.select(F.col("parent").alias("node")).union(left.select("child")).distinct()

        def colour(state, left=left):
            above = left.join(state, left["parent"] == state["node"]).groupBy("child").agg(F.max("colour").alias("above"))
            joined = state.join(above, state["node"] == above["child"], "left")
            return joined.select("node", F.greatest("colour", F.coalesce("above", "colour")).alias("colour"), F.coalesce(F.col("above") > F.col("colour"), F.lit(False)).alias("moved"))

        coloured, colour_path = _fixpoint(colour, *cut(nodes.select("node", F.col("node").alias("colour"), F.lit(True).alias("moved"))))
        colours = coloured.select("node", "colour")
        side = lambda name, colours=colours: colours.select(F.col("node").alias(name), F.col("colour").alias(f"{name}_colour"))
        inner, inner_path = cut(left.join(side("parent"), "parent").join(side("child"), "child").where("parent_colour = child_colour").select("parent", "child"))

        def reach(state, inner=inner):
            below = inner.join(state.where("inside"), inner["child"] == state["node"]).select(F.col("parent").alias("hit")).distinct()
            joined = state.join(below, state["node"] == below["hit"], "left")
            return joined.select("node", "colour", (F.col("inside") | F.col("hit").isNotNull()).alias("inside"), (~F.col("inside") & F.col("hit").isNotNull()).alias("moved"))

        reached, reach_path = _fixpoint(reach, *cut(colours.select("node", "colour", (F.col("node") == F.col("colour")).alias("inside"), F.lit(True).alias("moved"))))
        inside = reached.where("inside").select("node", F.col("colour").alias("component"))
        several = inside.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
        inside.join(several, "component", "left_semi").select("node", "component").write.mode("append").parquet(found_path)
        done = inside.select("node")
        rest, rest_path = cut(left.join(done.withColumnRenamed("node", "parent"), "parent", "left_anti").join(done.withColumnRenamed("node", "child"), "child", "left_anti").select("parent", "child"))
        for path in (left_path, colour_path, inner_path, reach_path):
            drop(spark, path)
        left, left_path = rest, rest_path
    drop(spark, left_path)
    return spark.read.schema(edges.selectExpr("parent as node", "parent as component").schema).parquet(found_path)


def back_edges(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(parent, child): the edges that the rule cuts, given ``strong_components``."""
    side = lambda name: components.select(F.col("node").alias(name), F.col("component").alias(f"{name}_c"))
    return edges.join(side("parent"), "parent").join(side("child"), "child").where("parent_c = child_c and child <= parent").select("parent", "child").distinct()


def _peeled(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """((node, depth) of the layers of edges, what is left where a cycle stops the peeling else None); edges is a written table."""
    spark = edges.sparkSession
    left, left_path = cut(edges)
    levels = f"{folder(spark)}/lexicarium/levels-{left_path.rsplit('-', 1)[-1]}"
    record = lambda nodes, depth: nodes.select("node", F.lit(depth).cast("int").alias("depth")).write.mode("append").parquet(levels)
    record(left.select(F.col("parent").alias("node")).limit(0), 0)
    read = lambda: spark.read.schema(f"node {left.schema['parent'].dataType.simpleString()}, depth int").parquet(levels)
    depth = 0
    while not left.isEmpty():
        below = left.select(F.col("child").alias("node")).distinct()
        tops, tops_path = cut(left.select(F.col("parent").alias("node")).distinct().join(below, "node", "left_anti"))
        if tops.isEmpty():
            return read(), left
        record(tops, depth)
        rest, rest_path = cut(left.join(tops.withColumnRenamed("node", "parent"), "parent", "left_anti").select("parent", "child"))
        freed = left.join(tops.withColumnRenamed("node", "parent"), "parent", "left_semi").select(F.col("child").alias("node")).distinct()
        for end in ("child", "parent"):  # a node with children of its own becomes a top of the next round
            freed = freed.join(rest.select(F.col(end).alias("node")).distinct(), "node", "left_anti")
        record(freed, depth + 1)
        for path in (left_path, tops_path):
            drop(spark, path)
        left, left_path, depth = rest, rest_path, depth + 1
    drop(spark, left_path)
    return read(), None


def hierarchy_depths(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((node, depth, on_cycle) of every node of ``nodes`` and of edges; (parent, child) of the edges that were cut).

    Nodes without edges have depth 0; edges to nodes that ``nodes`` does not list count like any other.
    """
    whole, path = cut(edges.where("parent <> child").select("parent", "child").distinct())
    levels, stuck = _peeled(whole)
    cut_edges, components = whole.limit(0), whole.selectExpr("parent as node", "parent as component").limit(0)
    if stuck is not None:
        components = strong_components(stuck)
        cut_edges, _ = cut(back_edges(stuck, components))
        levels, stuck = _peeled(whole.join(cut_edges, ["parent", "child"], "left_anti"))
        assert stuck is None, "edges that go up within components and between them cannot close a circle"
    every = nodes.select("node").union(whole.select("parent")).union(whole.select("child")).distinct()
    cycle = components.select("node", F.lit(True).alias("c_"))
    out = every.join(levels, "node", "left").join(cycle, "node", "left")
    return out.select("node", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("c_", F.lit(False)).alias("on_cycle")), cut_edges


def hierarchy_report(edges: DataFrame, register: DataFrame, kept: DataFrame, depths: DataFrame, cut_edges: DataFrame) -> DataFrame:
    """One row: edges read, used (both ends registered) and dropped, kept after pruning, nodes, greatest depth, nodes on cycles and edges cut."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    known = depths.agg(F.count(F.lit(1)).alias("nodes"), F.coalesce(F.max("depth"), F.lit(0)).alias("max_depth"), F.count_if("on_cycle").alias("nodes_on_cycles"))
    out = count(edges, "rows_read")
    for one in (count(registered_edges(edges, register), "rows_used"), count(kept, "edges_kept"), known, count(cut_edges, "edges_cut")):
        out = out.crossJoin(one)  # single rows
    return out.withColumn("rows_dropped", F.col("rows_read") - F.col("rows_used")).withColumn("cycle_detected", F.col("edges_cut") > 0)
