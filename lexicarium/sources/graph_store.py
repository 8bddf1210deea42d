"""Projections of units and conversations onto a stored graph: nodes and edges merged by key, counts verified.

A store is two published tables: nodes by (kind, node_id) and edges by (kind, src, dst). A merge keeps the batch
that first brought a node or edge (``created_in``), takes everything else from the last one and stamps it
(``synced_in``), so merging a batch again changes nothing. It rewrites only the buckets that it touches. Edges are
merged when both of their ends are nodes of the store; the others are counted, not stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicarium.operators.tables import cut, drop
from lexicarium.sources.published import PublishedTable

#: Kinds whose ends have no direction: they are stored in the order of their ids.
UNDIRECTED = ("CO_OCCURS_WITH",)

NODE, EDGE = ["kind", "node_id"], ["kind", "src", "dst"]


def _combined(both: DataFrame, key: list[str]) -> DataFrame:
    """Old and new rows of a key as one: everything of the new one but where it was created."""
    rest = [c for c in both.columns if c not in (*key, "is_new", "created_in")]
    out = both.groupBy(*key).agg(F.max_by(F.struct(*rest), "is_new").alias("r_"), F.min_by("created_in", "is_new").alias("created_in"))
    return out.select(*key, *[F.col(f"r_.{c}").alias(c) for c in rest], "created_in")


class GraphStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.nodes = PublishedTable(spark, f"{root}/nodes", NODE, buckets)
        self.edges = PublishedTable(spark, f"{root}/edges", EDGE, buckets)

    def merge_nodes(self, rows: DataFrame, sync_id: str) -> dict:
        """Merge nodes (kind, node_id, properties as JSON); of a repeated key in rows the greatest properties stay."""
        once = rows.where("kind is not null and node_id is not null").groupBy(*NODE).agg(F.max("properties").alias("properties"))
        stamped = once.withColumn("synced_in", F.lit(sync_id)).withColumn("created_in", F.lit(sync_id))
        return self.nodes.merge(stamped, _combined)

    def merge_edges(self, rows: DataFrame, sync_id: str, src_kind: str, dst_kind: str) -> dict:
        """Merge edges (kind, src, dst, weight) between nodes of two kinds; repeated ones keep their greatest weight. Returns the manifest with ``matched`` and ``unmatched`` edges."""
        turned = F.col("kind").isin(*UNDIRECTED) & (F.col("src") > F.col("dst"))
        ends = rows.where("kind is not null and src is not null and dst is not null").select("kind", F.when(turned, F.col("dst")).otherwise(F.col("src")).alias("src"), F.when(turned, F.col("src")).otherwise(F.col("dst")).alias("dst"), "weight")
        once, path = cut(ends.groupBy(*EDGE).agg(F.max("weight").alias("weight")))
        known = self.nodes.read()
        of = lambda kind, name: known.where(F.col("kind") == kind).select(F.col("node_id").alias(name))
        matched, matched_path = cut(once.join(of(src_kind, "src"), "src", "left_semi").join(of(dst_kind, "dst"), "dst", "left_semi").select(*EDGE, "weight"))
        n = matched.count()  # of a written table, as the count below
        manifest = self.edges.merge(matched.withColumn("synced_in", F.lit(sync_id)).withColumn("created_in", F.lit(sync_id)), _combined)
        manifest = manifest | {"matched": n, "unmatched": once.count() - n}
        for p in (path, matched_path):
            drop(self.spark, p)
        return manifest

    def counts(self) -> DataFrame:
        """(table, kind, n, distinct_keys) of the nodes and edges stored."""
        one = lambda table, name, key: table.read().groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*key).alias("distinct_keys")).select(F.lit(name).alias("table"), "kind", "n", "distinct_keys")
        return one(self.nodes, "nodes", NODE).unionByName(one(self.edges, "edges", EDGE))

    def verified(self) -> bool:
        """Whether the rows read back are those that the manifests name, without a repeated key, and every edge's ends are nodes."""
        per = {r.table: (r.n, r.d) for r in self.counts().groupBy("table").agg(F.sum("n").alias("n"), F.sum("distinct_keys").alias("d")).collect()}  # two rows
        for name, table in (("nodes", self.nodes), ("edges", self.edges)):
            rows = table.manifest()["rows"]
            if per.get(name, (0, 0)) != (rows, rows):
                return False
        ids = self.nodes.read().select("node_id").distinct()
        loose = [self.edges.read().join(ids.withColumnRenamed("node_id", end), end, "left_anti").isEmpty() for end in ("src", "dst")]
        return all(loose)


def unit_nodes(units: DataFrame, least: int = 1) -> DataFrame:
    """(kind, node_id, properties): the trimmed texts of units seen at least ``least`` times, with their count."""
    texts = units.select(F.trim("unit_text").alias("node_id")).where("node_id <> ''").groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))
    return texts.where(F.col("n") >= least).select(F.lit("StructuralUnit").alias("kind"), "node_id", F.to_json(F.struct("n")).alias("properties"))


def hierarchy_nodes(rows: DataFrame) -> DataFrame:
    """(kind, node_id, properties): conversations and their nodes (``asset::node``) of rows (asset_id, conversation_id, title, node_id, parent_id, role, depth, is_leaf, path, unit_text).

    A node's properties are those of its row of the least path and text; a conversation's title is its least one.
    """
    c = rows.where("conversation_id is not null").groupBy("conversation_id").agg(F.min("title").alias("title"))
    talks = c.select(F.lit("Conversation").alias("kind"), F.col("conversation_id").alias("node_id"), F.to_json(F.struct("title")).alias("properties"))
    own = F.struct("node_id", "role", "depth", "is_leaf", "asset_id")
    n = rows.where("node_id is not null").groupBy(_composite("node_id").alias("id")).agg(F.min_by(own, F.struct("path", "unit_text")).alias("p"))
    return talks.unionByName(n.select(F.lit("MappingNode").alias("kind"), F.col("id").alias("node_id"), F.to_json("p").alias("properties")))


def _composite(column: str):
    return F.concat_ws("::", F.coalesce("asset_id", F.lit("")), column)


def hierarchy_edges(rows: DataFrame, register: DataFrame | None = None, part_path: str = "message/content/parts") -> DataFrame:
    """(kind, src, dst, weight): HAS_NODE from conversations, PARENT_OF between nodes, CONTAINS_UNIT to trimmed texts that stand in content parts (registered ones, if a register of ``unit_text`` is given); each once."""
    nodes = rows.where("node_id is not null")
    has = nodes.where("conversation_id is not null").select(F.lit("HAS_NODE").alias("kind"), F.col("conversation_id").alias("src"), _composite("node_id").alias("dst"))
    parent = nodes.where("parent_id is not null and parent_id <> ''").select(F.lit("PARENT_OF").alias("kind"), _composite("parent_id").alias("src"), _composite("node_id").alias("dst"))
    holds = nodes.where(F.col("path").contains(part_path)).select(F.lit("CONTAINS_UNIT").alias("kind"), _composite("node_id").alias("src"), F.trim("unit_text").alias("dst")).where("dst <> ''")
    if register is not None:
        holds = holds.join(register.select(F.trim("unit_text").alias("dst")).distinct(), "dst", "left_semi").select("kind", "src", "dst")
    return has.unionByName(parent).unionByName(holds).distinct().withColumn("weight", F.lit(1).cast("long"))
