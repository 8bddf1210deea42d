"""Audits and attachments over concepts, instances, attributes, annotations and vectors: each audit is rows that violate it, or one row of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicarium.operators.units import COORDINATE


def _same(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def _renamed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*[F.col(k).alias(f"{k}_") for k in keys])


def matched(rows: DataFrame, targets: DataFrame, keys: list[str] = COORDINATE) -> DataFrame:
    """Rows whose null-safe key is among the targets."""
    return rows.join(_renamed(targets, keys).distinct(), _same(keys, [f"{k}_" for k in keys]), "left_semi")


def unmatched(rows: DataFrame, targets: DataFrame, keys: list[str] = COORDINATE) -> DataFrame:
    return rows.join(_renamed(targets, keys).distinct(), _same(keys, [f"{k}_" for k in keys]), "left_anti")


def anchor_verification(instances: DataFrame, units: DataFrame, keys: list[str] = COORDINATE) -> DataFrame:
    """One row: how many instances there are, and how many have their unit or lack it."""
    seen = instances.agg(F.count(F.lit(1)).alias("checked"))
    found = matched(instances, units, keys).agg(F.count(F.lit(1)).alias("found"))
    return seen.crossJoin(found).withColumn("missing", F.col("checked") - F.col("found"))  # two single rows


def conserved(selected: DataFrame, source: DataFrame, keys: list[str] = COORDINATE) -> DataFrame:
    """One row: selected and matched keys, and whether none was lost."""
    wanted = selected.select(*keys).distinct()
    counts = wanted.agg(F.count(F.lit(1)).alias("selected")).crossJoin(matched(wanted, source, keys).agg(F.count(F.lit(1)).alias("matched")))
    return counts.withColumn("conserved", F.col("selected") == F.col("matched"))


def topology(concepts: DataFrame, instances: DataFrame, attributes: DataFrame) -> DataFrame:
    """(check_name, violations) of a payload: instances and attributes without their object, repeated ids, attributes with several values.

    Concepts and what refers to them are counted by id in one grouping, whose tasks first add up their own rows; a null id refers to nothing.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    marked = lambda rows, key, kind: rows.select(F.col(key).alias("id"), *[(one if k == kind else none).alias(k) for k in ("c", "i", "a")])
    rows = marked(concepts, "concept_id", "c").unionByName(marked(instances, "concept_id", "i")).unionByName(marked(attributes.where("object_type = 'concept'"), "object_id", "a"))
    by = rows.groupBy("id").agg(F.sum("c").alias("c"), F.sum("i").alias("i"), F.sum("a").alias("a"))
    lost = F.col("id").isNull() | (F.col("c") == 0)
    total = lambda n: F.coalesce(F.sum(F.when(lost, F.col(n))), none)
    counts = by.agg(total("i").alias("instance_without_concept"), total("a").alias("attribute_without_object"), F.count_if(F.col("c") > 1).alias("repeated_concept"))
    own = counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in counts.columns])).alias("r")).select("r.*")  # three rows
    twice = lambda rows, key: rows.groupBy(key).count().where("count > 1")
    several = attributes.groupBy("object_type", "object_id", "attr_key").agg(F.min("attr_value").alias("low"), F.max("attr_value").alias("high")).where("low <> high")
    checks = {"repeated_instance": twice(instances, "instance_id"), "repeated_attribute": twice(attributes, "attr_id"), "attribute_conflict": several}
    return reduce(DataFrame.unionByName, [own, *[bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations") for name, bad in checks.items()]])


def run_counts(run_id: str, **tables: DataFrame) -> DataFrame:
    """(table_name, total, current): rows of each table and those of one run."""
    rows = [t.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("run_id") == run_id).alias("current")).select(F.lit(name).alias("table_name"), "total", "current") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def attached(rows: DataFrame, annotations: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """rows with the payload that their key's annotations agree on and its status: attached, ambiguous (they differ; no payload) or missing."""
    side = annotations.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(F.count_distinct(payload).alias("n_"), F.min(payload).alias("value_"))
    joined = rows.join(side, _same(keys, [f"{k}_" for k in keys]), "left")
    status = F.when(F.coalesce("n_", F.lit(0)) == 0, "missing").when(F.col("n_") > 1, "ambiguous").otherwise("attached")
    return joined.withColumn("attach_status", status).withColumn(payload, F.when(status == "attached", F.col("value_"))).drop(*[f"{k}_" for k in keys], "n_", "value_")


def replay_digest(rows: DataFrame, key: list[str], drop: tuple[str, ...] = ("generated_at",), buckets: int = 64) -> DataFrame:
    """One row (rows, digest): the same for equal bags of records in any order. Records are hashed as JSON with sorted fields; the hashes are summed in ``buckets`` groups, so no task holds all of them."""
    fields = sorted(c for c in rows.columns if c not in drop)
    h = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields]), {"ignoreNullFields": "false"}), 256)
    hashed = rows.select(h.alias("h")).withColumn("b", F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % buckets)
    # a sum of hashes a bucket is order-free and needs no sorted list of all records
    part = lambda at: F.sum(F.conv(F.substring("h", at, 12), 16, 10).cast("decimal(38,0)"))
    by = hashed.groupBy("b").agg(F.count(F.lit(1)).alias("n"), part(1).alias("x"), part(13).alias("y"), part(25).alias("z"))
    return by.agg(F.sum("n").alias("rows"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "n", "x", "y", "z"))), lambda r: F.concat_ws(":", r["b"].cast("string"), r["n"].cast("string"), r["x"].cast("string"), r["y"].cast("string"), r["z"].cast("string"))), "|"), 256).alias("digest"))


def record_differences(a: DataFrame, b: DataFrame, key: list[str], drop: tuple[str, ...] = ("generated_at",)) -> DataFrame:
    """(key, difference): records of one side only, and records of equal key that differ."""
    fields = sorted(c for c in a.columns if c not in drop)
    hashed = lambda rows: rows.select(*key, F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields]), {"ignoreNullFields": "false"}), 256).alias("h"))
    both = hashed(a).join(hashed(b).withColumnRenamed("h", "h2"), key, "full")
    return both.select(*key, F.when(F.col("h").isNull(), "right_only").when(F.col("h2").isNull(), "left_only").when(F.col("h") != F.col("h2"), "changed").alias("difference")).where("difference is not null")


# --- vectors ---------------------------------------------------------------------------------
def active_index(log: DataFrame) -> DataFrame:
    """The state index: of each (object_type, object_id) its last record in order, where that is active; without vectors."""
    last = log.groupBy("object_type", "object_id").agg(F.max_by(F.struct("signature", "state"), "seq").alias("r"))
    return last.where("r.state = 'active'").select("object_type", "object_id", "r.signature")


def several_active(log: DataFrame) -> DataFrame:
    """(object_type, object_id, n): objects with more than one active signature."""
    return log.where("state = 'active'").groupBy("object_type", "object_id").agg(F.count_distinct("signature").alias("n")).where("n > 1")


def contract_errors(records: DataFrame, sources: DataFrame, dimension: int) -> DataFrame:
    """(object_id, errors) of embedding records that break the contract: no source, another source hash, a wrong or not finite vector."""
    joined = records.join(sources.select(F.col("object_id").alias("s_"), F.col("source_hash").alias("known_")), F.col("object_id") == F.col("s_"), "left")
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    errors = F.array_compact(F.array(F.when(F.col("known_").isNull(), "source_missing"), F.when(F.col("known_") != F.col("source_hash"), "source_changed"), F.when(v.isNull() | (F.size(v) != dimension), "dimension"), F.when(~finite, "not_finite")))
    return joined.select("object_id", errors.alias("errors")).where(F.size("errors") > 0)


def consistency(index: DataFrame, store: DataFrame) -> DataFrame:
    """(side, n): index entries without a vector and vectors without an entry, by one full join."""
    both = index.select("object_id", F.lit(1).alias("i")).join(store.select("object_id", F.lit(1).alias("s")), "object_id", "full")
    side = F.when(F.col("s").isNull(), "index_only").when(F.col("i").isNull(), "store_only").otherwise("both")
    return both.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


# --- text locations --------------------------------------------------------------------------
def verified_evidence(refs: DataFrame, sources: DataFrame) -> DataFrame:
    """refs with the text they point to and whether it is verified: inside the source, and of the hash that the reference names."""
    joined = refs.join(sources.select(F.col("source_id").alias("s_"), F.col("text").alias("whole_")), F.col("source_id") == F.col("s_"), "left")
    inside = (F.col("span_start") >= 0) & (F.col("span_end") >= F.col("span_start")) & (F.col("span_end") <= F.length("whole_"))
    found = F.when(inside, F.substr("whole_", (F.col("span_start") + 1).cast("int"), (F.col("span_end") - F.col("span_start")).cast("int")))
    return joined.withColumn("evidence", found).withColumn("verified", F.coalesce(F.sha2(found, 256) == F.col("span_hash"), F.lit(False))).drop("s_", "whole_")
