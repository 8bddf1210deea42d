"""Selections closed over references: what a selected object needs, followed to the end, with a policy for what is missing.

Objects are (kind, id), references (kind, id, relation, to_kind, to_id). A round follows the references of what
the round before found, so rows are joined once each; rounds grow with the longest chain of references from
the selection. Objects that are referred to but not there are kept as boundary references (policy ``preserve``)
or an error (``reject``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicarium.operators.sequences import sequence_digest
from lexicarium.operators.tables import cut, drop, folder

OBJECT = ["kind", "id"]


class MissingObject(ValueError):
    """A closure refers to an object that is not there, and the policy rejects that."""


def closure(selected: DataFrame, references: DataFrame, objects: DataFrame, missing_policy: str = "preserve") -> DataFrame:
    """(kind, id, hops, missing) of all that the selection reaches: hops is the least number of references from it. A written table.

    Selected objects that are not there are missing like any other; repeated selections count once. Null ids refer to nothing.
    """
    if missing_policy not in ("preserve", "reject"):
        raise ValueError("missing_policy is preserve or reject")
    spark = selected.sparkSession
    edges, edges_path = cut(references.where("id is not null and to_id is not null").select(*OBJECT, "to_kind", "to_id").distinct())
    frontier, frontier_path = cut(selected.where("id is not null").select(*OBJECT).distinct())
    found_path = f"{folder(spark)}/lexicarium/closure-{frontier_path.rsplit('-', 1)[-1]}"
    hops = 0
    while True:
        frontier.withColumn("hops", F.lit(hops)).write.mode("append").parquet(found_path)
        found = spark.read.parquet(found_path)
        reached = frontier.join(edges, OBJECT).select(F.col("to_kind").alias("kind"), F.col("to_id").alias("id")).distinct()
        new, new_path = cut(reached.join(found.select(*OBJECT), OBJECT, "left_anti"))
        drop(spark, frontier_path)
        frontier, frontier_path, hops = new, new_path, hops + 1
        if frontier.isEmpty():
            break
    drop(spark, frontier_path)
    drop(spark, edges_path)
    there = objects.select(*OBJECT, F.lit(True).alias("there_")).distinct()
    out, path = cut(spark.read.parquet(found_path).join(there, OBJECT, "left").select(*OBJECT, "hops", F.col("there_").isNull().alias("missing")))
    drop(spark, found_path)
    if missing_policy == "reject":
        lost = out.where("missing").orderBy("hops", *OBJECT).first()
        if lost:
            drop(spark, path)
            raise MissingObject(f"{lost.kind} {lost.id} is referred to and not there")
    return out


def selection_of_assets(instances: DataFrame, attributes: DataFrame, assets: DataFrame) -> DataFrame:
    """(kind, id): the instances of the given assets, their concepts, and the attributes of both."""
    own = instances.join(assets.select("asset_id").distinct(), "asset_id", "left_semi")
    base = own.select(F.lit("instance").alias("kind"), F.col("instance_id").alias("id")).unionByName(own.select(F.lit("concept").alias("kind"), F.col("concept_id").alias("id"))).distinct()
    of = attributes.select(F.col("object_type").alias("kind"), F.col("object_id").alias("id"), "attr_id").join(base, OBJECT, "left_semi")
    return base.unionByName(of.select(F.lit("attribute").alias("kind"), F.col("attr_id").alias("id")))


def links(closed: DataFrame, references: DataFrame) -> DataFrame:
    """The references between objects of a closure, boundary references included."""
    ids = closed.select(*OBJECT)
    return references.join(ids, OBJECT, "left_semi").join(ids.select(F.col("kind").alias("to_kind"), F.col("id").alias("to_id")), ["to_kind", "to_id"], "left_semi").select(*OBJECT, "relation", "to_kind", "to_id").distinct()


def replay_records(closed: DataFrame, bodies: DataFrame, references: DataFrame) -> DataFrame:
    """(record_type, kind, id, json): a line an object of the closure with its body (null where missing) and a line a reference between them."""
    records = closed.join(bodies.select(*OBJECT, "body"), OBJECT, "left")
    objects = records.select(F.lit("object").alias("record_type"), *OBJECT, F.to_json(F.struct("kind", "id", "hops", "missing", "body"), {"ignoreNullFields": "false"}).alias("json"))
    edges = links(closed, references)
    return objects.unionByName(edges.select(F.lit("relation").alias("record_type"), *OBJECT, F.to_json(F.struct("kind", "id", "relation", "to_kind", "to_id")).alias("json")))


def replay_manifest(records: DataFrame, closed: DataFrame, missing_policy: str = "preserve") -> DataFrame:
    """One row: records, objects, relations, missing objects, policy, and a digest of the records that does not depend on their order."""
    counts = records.agg(F.count(F.lit(1)).alias("record_count"), F.count_if(F.col("record_type") == "object").alias("objects"), F.count_if(F.col("record_type") == "relation").alias("relations"))
    lost = closed.agg(F.count_if("missing").alias("missing"))
    place: Column = F.lit(0)
    digest = sequence_digest(records.withColumn("place_", place), [], "place_", F.col("json")).select(F.col("digest").alias("content_hash"))
    return counts.crossJoin(lost).crossJoin(digest).withColumn("missing_policy", F.lit(missing_policy))  # single rows


def export_replay(records: DataFrame, manifest: DataFrame, path: str) -> None:
    """Write the manifest and the records as JSON lines below path, the manifest last: an export without it is not complete."""
    records.select("json").write.text(f"{path}/records")
    manifest.select(F.to_json(F.struct(*manifest.columns)).alias("json")).write.text(f"{path}/manifest")
