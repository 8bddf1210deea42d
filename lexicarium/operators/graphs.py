"""Graphs over text units and conversations: edges, pruning, statistics, components, trees, neighbourhoods."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicarium.operators.tables import cut, drop
from lexicarium.operators.units import CONTAINER, containers_apart, split_pairs, split_units

#: ``skipped_containers`` reports containers of more units than this unless told otherwise.
MOST_UNITS = 500
#: Pairs are listed in lines of up to this many units; in longer ones they follow from counts.
SLICE = 500
#: Pairs that a task holds before it passes them on.
PAIRS = 200_000
SEGMENT = [*CONTAINER, "segment_index"]


def adjacency_edges(units: DataFrame) -> DataFrame:
    """(src, dst, weight): consecutive units of a segment; no self-loops."""
    order = Window.partitionBy(*SEGMENT).orderBy("sentence_index", "char_start", "char_end")
    steps = units.select(F.col("unit_text").alias("src"), F.lead("unit_text").over(order).alias("dst")).where("dst is not null and src <> dst")
    return steps.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def adjacency_pairs(values: DataFrame) -> DataFrame:
    """(src, dst, n): the adjacency edges of the units of values, not yet added up; containers that several values share are ordered as a whole."""
    alone, shared = containers_apart(values)
    pairs = split_pairs(alone)
    return pairs if shared is None else pairs.unionByName(adjacency_edges(split_units(shared)).withColumnRenamed("weight", "n"))


def cooccurrence_edges(units: DataFrame, most: int | None = None, size: int = SLICE) -> DataFrame:
    """(src, dst, weight): pairs i < j in text order within a segment; no self-loops. ``most`` leaves larger segments out, none by default."""
    placed = F.array_sort(F.collect_list(F.struct("sentence_index", "char_start", "char_end", "unit_text")))
    lines = units.groupBy(*SEGMENT).agg(F.transform(placed, lambda x: x["unit_text"]).alias("u"))
    return line_edges((lines.where(F.size("u") <= most) if most is not None else lines).select("u", F.lit(1).cast("long").alias("n")), size)


def line_edges(lines: DataFrame, size: int = SLICE) -> DataFrame:
    """The co-occurrence edges of lines (u, n): a line's texts in order, and how often it stands there; equal lines may come in several rows.

    Equal lines are paired once. A text that no other line holds has all its pairs in its line, so their weights are final there; only
    pairs of two texts that stand in several lines each are summed over lines. Texts are told apart by hashes for that, and two with
    one hash count as texts of several lines. Pairs of lines of up to ``size`` texts are listed, those of longer lines follow from counts.
    """
    key = F.coalesce(F.unhex(F.md5(F.to_json(F.struct("u")))), F.lit(b""))  # never null, which Spark must see
    keyed = lines.where(F.size("u") > 1).select(key.alias("key"), "u", "n").repartition("key")
    # dealt out by key already, and so joined below; all three readers keep every column (n is positive) and need no null checks, so Spark shuffles the lines once
    once = keyed.groupBy("key", "u").agg(F.sum("n").alias("n")).where("n > 0")
    hashes = F.transform("u", lambda x: F.xxhash64(x))
    seen = once.select("key", F.explode(F.array_distinct(hashes)).alias("h"))
    of = Window.partitionBy("h")
    several = seen.withColumn("low", F.min("key").over(of)).withColumn("high", F.max("key").over(of)).where("low <> high")
    marks = several.groupBy("key").agg(F.collect_list("h").alias("marks"))
    marked = once.join(marks, "key", "left").select("u", hashes.alias("h"), "marks", "n")
    edge = "src string, dst string, weight long"
    own = marked.mapInArrow(lambda it: _line_pairs(it, size, False), edge)
    shared = marked.where(F.size("marks") > 1).mapInArrow(lambda it: _line_pairs(it, size, True), edge)
    return own.unionByName(shared.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def _line_pairs(batches, size: int, shared: bool):
    """Weighted pairs of distinct lines: those of two marked texts, or all others, which no other line has."""
    for batch in batches:
        texts = batch.column("u").flatten().dictionary_encode()
        code = texts.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        mark = np.isin(batch.column("h").flatten().to_numpy(), batch.column("marks").flatten().to_numpy())
        line = np.repeat(np.arange(len(batch)), batch.column("u").value_lengths().to_numpy())
        n = batch.column("n").to_numpy()
        kept = (code >= 0) & mark if shared else code >= 0
        if not shared:  # a line all of whose texts are marked has none of the others
            kept &= np.bincount(line[~mark], minlength=len(batch))[line] > 0
        code, mark, line = code[kept], mark[kept] & (not shared), line[kept]
        found, held = [], 0
        for part in _counted(code, mark, line, n, size, len(texts.dictionary)):
            found.append(part)
            held += len(part[0])
            if held >= PAIRS:
                yield from _edges(found, texts.dictionary)
                found, held = [], 0
        yield from _edges(found, texts.dictionary)


def _edges(found, names):
    """Record batches of (codes, codes, weights)."""
    if found:
        src, dst, weight = (np.concatenate(c) for c in zip(*found))
        for k in range(0, len(src), PAIRS):
            yield pa.RecordBatch.from_arrays([names.take(pa.array(src[k : k + PAIRS])), names.take(pa.array(dst[k : k + PAIRS])), pa.array(weight[k : k + PAIRS], pa.int64())], ["src", "dst", "weight"])


def _counted(code, mark, line, n, size, names):
    """(codes, codes, weights) of each pair once for a few lines; pairs of two marked texts are left out. Memory is that of ``PAIRS`` pairs, of the pairs of ``size`` texts or of one line's texts."""
    units = np.bincount(line, minlength=len(n))
    end = np.cumsum(units)
    # lines of up to ``size`` texts: their pairs as a list, sorted and summed, many lines at a time
    upto = np.cumsum(np.where(units <= size, units * (units - 1) // 2, 0))
    cuts = np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, PAIRS), side="right")
    for first, last in zip(cuts, [*cuts[1:], len(n)]):
        at = np.arange(end[first] - units[first], end[last - 1]) if last > first else np.arange(0)
        at = at[units[line[at]] <= size]
        after = end[line[at]] - 1 - at
        a = np.repeat(at, after)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
        good = (code[a] != code[b]) & ~(mark[a] & mark[b])
        a, b = a[good], b[good]
        if len(a):
            key = code[a] * names + code[b]
            order = np.argsort(key, kind="stable")
            key = key[order]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            yield key[starts] // names, key[starts] % names, np.add.reduceat(n[line[a]][order], starts)
    # longer ones: for each text, how many of it stand before every text
    for k in np.flatnonzero(units > size):
        row = slice(end[k] - units[k], end[k])
        own, first, place = np.unique(code[row], return_index=True, return_inverse=True)
        marked = mark[row][first]
        for x in range(len(own)):
            rest = place[first[x] :]
            weight = np.bincount(rest, np.cumsum(rest == x), len(own)).astype(np.int64)
            weight[x] = 0
            if marked[x]:
                weight[marked] = 0
            to = np.flatnonzero(weight)
            yield np.full(len(to), own[x]), own[to], weight[to] * n[k]


def skipped_containers(units: DataFrame, most: int = MOST_UNITS) -> DataFrame:
    """(reason, n): how many containers co-occurrence leaves out when it is given ``most``."""
    sizes = units.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("n"))
    return sizes.where(F.col("n") > most).agg(F.count(F.lit(1)).alias("n")).select(F.lit("container_too_large").alias("reason"), "n")


def prune_edges(edges: DataFrame, least: int = 1, per_node: int = 10, most: int | None = None) -> DataFrame:
    """Edges of at least ``least``, among the top ``per_node`` of either endpoint, then the ``most`` heaviest."""
    strong = edges.where(F.col("weight") >= least)
    ends = strong.select(F.col("src").alias("node"), "src", "dst", "weight").unionByName(strong.select(F.col("dst").alias("node"), "src", "dst", "weight"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("weight"), "src", "dst"))
    kept = ends.withColumn("r", rank).where(F.col("r") <= per_node).select("src", "dst", "weight").distinct()
    return kept.orderBy(F.desc("weight"), "src", "dst").limit(most) if most else kept


def pruned_pairs(pairs: DataFrame, per_node: int) -> DataFrame:
    """``prune_edges`` of pairs (src, dst, n) that are edges once added up: those among the top ``per_node`` of either endpoint.

    Pairs are shuffled once by either end, by ``short_key``s, and with one text by the second. An edge's place at a node follows from the
    node's best edges out and in, which lie beside it then; only edges that their first end does not keep are shuffled again, to their
    second. Two edges of one node have other first texts or are both edges out, so a weight and a first text tell edges out from edges in.
    """
    key = lambda end: F.coalesce(short_key(end), F.lit(b"")).alias("key")  # noqa: E731  never null, else some readers ask for that and Spark shuffles anew for them
    pairs = pairs.where("src is not null and dst is not null")
    summed = lambda end, *texts: pairs.select(key(end), *texts, "n").repartition("key").groupBy("key", *texts).agg(F.sum("n").alias("weight"))
    ranked = lambda edges, text: edges.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("weight"), text)))
    place = F.struct((-F.col("weight")).alias("low"), "src")
    best = lambda edges, name: edges.where(F.col("r") <= per_node).groupBy(F.col("key").alias(f"{name}_key")).agg(F.collect_list(place).alias(name))
    ahead = lambda name: F.coalesce(F.size(F.filter(name, lambda x: x < place)), F.lit(0))
    out, into = ranked(summed("src", "src", "dst"), "dst"), best(ranked(summed("dst", "src"), "src"), "into")
    first = out.join(into, F.col("key") == F.col("into_key"), "left").select("src", "dst", "weight", (F.col("r") + ahead("into") <= per_node).alias("kept"))
    rest = first.where("not kept").select(key("dst"), "src", "dst", "weight")
    second = rest.join(into, F.col("key") == F.col("into_key"), "left").join(best(out, "out"), F.col("key") == F.col("out_key"), "left").where(ahead("into") + ahead("out") < per_node)
    return first.where("kept").drop("kept").unionByName(second.select("src", "dst", "weight"))


def edges_between(edges: DataFrame, register: DataFrame) -> DataFrame:
    """Edges both of whose ends are registered."""
    nodes = register.select("node").distinct()
    return edges.join(nodes.withColumnRenamed("node", "src"), "src", "left_semi").join(nodes.withColumnRenamed("node", "dst"), "dst", "left_semi").select("src", "dst", "weight")


def named_edges(edges: DataFrame, register: DataFrame) -> DataFrame:
    """Edges between ``short_key``s as edges between the registered names; those without a registered end go."""
    names = register.select("node").distinct().select(short_key("node").alias("key"), "node")
    of = lambda end: names.select(F.col("key").alias(end), F.col("node").alias(f"{end}_"))
    return edges.join(of("src"), "src").join(of("dst"), "dst").select(F.col("src_").alias("src"), F.col("dst_").alias("dst"), "weight")


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, in_degree, out_degree, degree), isolated nodes included."""
    ends = edges.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(edges.select(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    counted = ends.groupBy("node").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    return nodes.join(counted, "node", "left").select("node", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("in_degree", "out_degree")]).withColumn("degree", F.col("in_degree") + F.col("out_degree"))


def graph_statistics(nodes: DataFrame, edges: DataFrame, directed: bool = True) -> DataFrame:
    """One row: node and edge counts, density, degree and weight summaries."""
    d = degrees(nodes, edges).agg(F.count(F.lit(1)).alias("node_count"), F.min("degree").alias("min_degree"), F.max("degree").alias("max_degree"), F.round(F.avg("degree"), 6).alias("mean_degree"))
    w = edges.agg(F.count(F.lit(1)).alias("edge_count"), F.min("weight").alias("min_weight"), F.max("weight").alias("max_weight"), F.round(F.avg("weight"), 6).alias("mean_weight"))
    both = d.crossJoin(w)  # two single rows
    n, e = F.col("node_count"), F.col("edge_count")
    return both.withColumn("density", F.when(n > 1, F.round((1 if directed else 2) * e / (n * (n - 1)), 12)).otherwise(0.0))


def degree_histogram(degree: DataFrame, width: int = 5, last: int = 200) -> DataFrame:
    """(bucket, n): degrees in buckets of ``width``, one overflow bucket from ``last``."""
    low = (F.floor(F.col("degree") / width) * width).cast("int")
    label = F.when(F.col("degree") >= last, F.lit(f"{last}+")).otherwise(F.concat_ws("-", low, low + width - 1))
    return degree.groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def weak_components(edges: DataFrame) -> DataFrame:
    """(node, component): least node reachable over edges either way, until nothing changes; a written table a round, of which the last stays.

    Nodes with names go through the rounds by 16 bytes of their MD5; their names are joined at the end.
    """
    if dict(edges.dtypes)["src"] != "string":
        return _labels(edges)
    named, path = cut(edges.select("src", "dst"))
    labels = _labels(named.select(short_key("src").alias("src"), short_key("dst").alias("dst")))
    names = nodes_of(named).select("node", short_key("node").alias("key"))
    members, own = cut(labels.select(F.col("node").alias("key"), F.col("component").alias("root")).join(names, "key").select("node", "root"))
    least = members.groupBy("root").agg(F.min("node").alias("component"))
    out, _ = cut(members.join(least, "root").select("node", "component"))
    for p in (path, own):
        drop(edges.sparkSession, p)
    return out


def short_key(name: str) -> Column:
    """A name's identity in 16 bytes."""
    return F.unhex(F.md5(F.col(name)))


def component_sizes(edges: DataFrame) -> DataFrame:
    """(component, n); give named nodes by their ``short_key``, and no names are shuffled."""
    return _labels(edges).groupBy("component").agg(F.count(F.lit(1)).alias("n"))


def _labels(edges: DataFrame) -> DataFrame:
    """(node, component) by contraction: every node is merged into the least of itself and its neighbours, edges move along, equal ones and loops go, until none is left; then the merges are followed.

    What a round reads shrinks from round to round. A component's least node is never merged into another.
    """
    spark = edges.sparkSession
    level, path = cut(edges.where("src is not null and dst is not null").select("src", "dst").union(edges.where("src is not null and dst is not null").select("dst", "src")).distinct())
    merges, paths = [], []
    while True:
        merge, own = cut(level.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).select("node", F.least("node", "low").alias("component")))
        merges.append(merge)
        paths.append(own)
        a, b = (merge.select(F.col("node").alias(f"{e}_"), F.col("component").alias(f"new_{e}")) for e in ("src", "dst"))
        moved = level.join(a, F.col("src") == F.col("src_")).join(b, F.col("dst") == F.col("dst_")).where("new_src <> new_dst").select(F.col("new_src").alias("src"), F.col("new_dst").alias("dst")).distinct()
        level, new = cut(moved)
        drop(spark, path)
        path = new
        if level.isEmpty():
            break
    labels = merges.pop()
    while merges:
        later = labels.select(F.col("node").alias("at_"), F.col("component").alias("root_"))
        labels = merges.pop().join(later, F.col("component") == F.col("at_"), "left").select("node", F.coalesce("root_", "component").alias("component"))
    out, _ = cut(labels)
    for p in (path, *paths):
        drop(spark, p)
    return out


def component_summary(components: DataFrame) -> DataFrame:
    """One row: number of components and nodes of the largest."""
    return size_summary(components.groupBy("component").agg(F.count(F.lit(1)).alias("n")))


def size_summary(sizes: DataFrame) -> DataFrame:
    """``component_summary`` from the components' sizes."""
    return sizes.agg(F.count(F.lit(1)).alias("component_count"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_size"))


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """(asset_id, node_id, parent_id, role, text): each turn is a node below the turn before it."""
    key = lambda t: F.concat_ws(":", F.col("conv_id").cast("string"), t.cast("string"))
    before = F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn"))
    return conversations.select(F.col("conv_id").cast("string").alias("asset_id"), key(F.col("turn")).alias("node_id"), F.when(before.isNotNull(), key(before)).alias("parent_id"), canonical_role(F.col("role")).alias("role"), "text")


def canonical_role(role: Column) -> Column:
    """Role aliases (fixed values) to user, assistant, system, tool or unknown."""
    alias = {"user": "user", "human": "user", "assistant": "assistant", "ai": "assistant", "bot": "assistant", "system": "system", "tool": "tool", "function": "tool"}
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in alias.items() for x in kv]), F.lower(F.trim(role))), F.lit("unknown"))


def tree_depths(nodes: DataFrame, most: int | None = None) -> DataFrame:
    """nodes with depth (roots 0, nodes that no root reaches -1) and is_leaf, by doubling pointers: rounds grow with the logarithm of the depth. ``most`` stops once that many steps are looked at; by default all are."""
    up = nodes.select("node_id", "parent_id")
    known = up.join(up.select(F.col("node_id").alias("p")), up["parent_id"] == F.col("p"), "left")
    jump, path = cut(known.select("node_id", F.col("p").alias("anchor"), F.when(F.col("p").isNull(), 0).otherwise(1).alias("steps"), (F.col("parent_id").isNull()).alias("rooted")))
    reach, left = 1, jump.where("anchor is not null").count()
    while left and (most is None or reach < most):
        up2 = jump.select(F.col("node_id").alias("a"), F.col("anchor").alias("a2"), F.col("steps").alias("s2"), F.col("rooted").alias("r2"))
        jump, new = cut(jump.join(up2, jump["anchor"] == up2["a"], "left").select("node_id", F.col("a2").alias("anchor"), (F.col("steps") + F.coalesce("s2", F.lit(0))).alias("steps"), F.coalesce("r2", "rooted").alias("rooted")))
        drop(nodes.sparkSession, path)
        path, reach = new, reach * 2
        before, left = left, jump.where("anchor is not null").count()
        if left == before:  # no depth between reach / 2 and reach, so none beyond: what is left is in or below cycles
            break
    depth = F.when(F.col("anchor").isNull() & F.col("rooted"), F.col("steps")).otherwise(-1)
    parents = nodes.where("parent_id is not null").select(F.col("parent_id").alias("pid")).distinct()
    out = nodes.join(jump, "node_id").withColumn("depth", depth).drop("anchor", "steps", "rooted")
    return out.join(parents, out["node_id"] == parents["pid"], "left").withColumn("is_leaf", F.col("pid").isNull()).drop("pid")


def neighbourhood(edges: DataFrame, start: DataFrame, hops: int = 4, most: int = 100) -> DataFrame:
    """(node, hop): nodes within ``hops`` (at most 4) of the start nodes, either direction, the first ``most`` by hop and name (a bounded report)."""
    both = edges.select("src", "dst").union(edges.select("dst", "src")).distinct()
    found = start.select("node", F.lit(0).alias("hop"))
    frontier = found
    for k in range(1, min(hops, 4) + 1):
        step = frontier.join(both, frontier["node"] == both["src"]).select(F.col("dst").alias("node")).distinct()
        frontier = step.join(found.select("node"), "node", "left_anti").withColumn("hop", F.lit(k))
        found = found.unionByName(frontier)
    return found.orderBy("hop", "node").limit(most)


def normalised_edges(edges: DataFrame, directed: bool = True) -> DataFrame:
    """(src, dst, weight): weight, else count, else 1; negative ones 0; endpoints of undirected edges in order, parallel edges kept."""
    found = [F.col(c).cast("double") for c in ("weight", "count") if c in edges.columns]
    weight = F.greatest(F.coalesce(*found, F.lit(1.0)), F.lit(0.0))
    ends = (F.col("src"), F.col("dst")) if directed else (F.least("src", "dst"), F.greatest("src", "dst"))
    return edges.where("src is not null and dst is not null").select(ends[0].alias("src"), ends[1].alias("dst"), weight.alias("weight"))


def hierarchy_edges(edges: DataFrame, per_parent: int | None = None) -> DataFrame:
    """(parent, child, weight): repeated edges keep their largest weight; of each parent the ``per_parent`` heaviest children, if given."""
    once = edges.groupBy("parent", "child").agg(F.max("weight").alias("weight"))
    if per_parent is None:
        return once
    rank = F.row_number().over(Window.partitionBy("parent").orderBy(F.desc("weight"), "child"))
    return once.withColumn("r_", rank).where(F.col("r_") <= per_parent).drop("r_")


def tree_statistics(tree: DataFrame) -> DataFrame:
    """One row over nodes with depth and is_leaf (``tree_depths``): nodes, roots, leaves, greatest depth, nodes with a parent that is none of them, and whether some node hangs on a cycle."""
    known = tree.select(F.col("node_id").alias("k_")).distinct()
    dangling = tree.where("parent_id is not null").join(known, F.col("parent_id") == F.col("k_"), "left_anti").agg(F.count(F.lit(1)).alias("dangling_parents"))
    own = tree.agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("parent_id").isNull()).alias("roots"), F.count_if("is_leaf").alias("leaves"), F.max("depth").alias("max_depth"), F.count_if(F.col("depth") < 0).alias("unreached"))
    return own.crossJoin(dangling).withColumn("has_cycle", (F.col("unreached") > 0) & (F.col("dangling_parents") == 0))  # two single rows


def snapshot_trend(snapshots: DataFrame) -> DataFrame:
    """One row over snapshots (taken, node_count, edge_count, density): how many, their time range, and least, mean and greatest of each figure; snapshots without counts are left out."""
    used = snapshots.where("node_count is not null and edge_count is not null and taken is not null")
    figures = [f(c).alias(f"{c}_{name}") for c in ("node_count", "edge_count", "density") for name, f in (("min", F.min), ("mean", lambda c: F.round(F.avg(c), 6)), ("max", F.max))]
    return used.agg(F.count(F.lit(1)).alias("snapshots"), F.min("taken").alias("first_taken"), F.max("taken").alias("last_taken"), *figures)


RELATIONS = ("follows", "modifies", "based_on", "caused_by")


def relation_problems(relations: DataFrame, nodes: DataFrame) -> DataFrame:
    """relations with ``problem``: unknown kind, a reference to itself, an unknown end; null for those that may be appended."""
    known = nodes.select("node").distinct()
    out = relations.join(known.select(F.col("node").alias("a_")), F.col("src") == F.col("a_"), "left").join(known.select(F.col("node").alias("b_")), F.col("dst") == F.col("b_"), "left")
    problem = F.when(~F.coalesce(F.col("kind").isin(*RELATIONS), F.lit(False)), "unknown_kind").when(F.col("src") == F.col("dst"), "self_reference").when(F.col("a_").isNull() | F.col("b_").isNull(), "unknown_end")
    return out.withColumn("problem", problem).drop("a_", "b_")


def payload(edges: DataFrame) -> DataFrame:
    """Edges as JSON lines of a drawing: source, target, weight."""
    return edges.select(F.to_json(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), "weight")).alias("json"))
