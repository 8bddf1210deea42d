"""Concepts, instances and attributes: content-hash and coordinate-hash identities, idempotent appends, audits, presets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicarium import policy
from lexicarium.operators.units import COORDINATE


def component_hash(*columns: str) -> Column:
    """SHA-256 of the components joined by '|', nulls as NULL."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]), 256)


def concept_declarations(decisions: DataFrame, canonical: Callable[[Column], Column] = F.trim) -> DataFrame:
    """(concept_id, unit_text) of allowed texts (a missing decision passes), one of equal canonical texts; ``canonical`` trims by default, see ``text.canonicaliser``."""
    allowed = decisions.where(F.col("decision").isNull() | (F.col("decision") == "ALLOW")).select("unit_text").distinct()
    kept = allowed.select(canonical(F.col("unit_text")).alias("unit_text")).where("unit_text <> ''").distinct()
    return kept.select(F.sha2("unit_text", 256).alias("concept_id"), "unit_text")


INSTANCE_PARTS = ["concept_id", "asset_id", "path", "segment_index", "char_start", "char_end"]


def instance_declarations(units: DataFrame, concepts: DataFrame | None = None, canonical: Callable[[Column], Column] = F.trim) -> DataFrame:
    """(instance_id, concept_id, coordinate) of units; with ``concepts``, of those only whose concept is declared (a semi-join on its id, without texts)."""
    own = units.where("trim(unit_text) <> ''").withColumn("concept_id", F.sha2(canonical(F.col("unit_text")), 256))
    own = own.join(concepts.select("concept_id"), "concept_id", "left_semi") if concepts is not None else own
    return own.select(component_hash(*INSTANCE_PARTS).alias("instance_id"), "concept_id", *COORDINATE)


def stable_attribute_id(scope: Column | None = None, kind: Column | None = None, state: str = "active", evidence: Column | None = None, creator: str = "lexicarium") -> Column:
    """SHA-256 of the nine fields of an attribute, missing ones as the empty string."""
    none = F.lit("")
    parts = [F.col("object_type"), F.col("object_id"), scope if scope is not None else none, F.col("attr_key"), F.col("attr_value"), kind if kind is not None else none, F.lit(state), evidence if evidence is not None else none, F.lit(creator)]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), none) for p in parts]), 256)


def concept_attributes(profile: DataFrame, allowed: dict = policy.ATTRIBUTES, gate: bool = True, order: str | None = None, canonical: Callable[[Column], Column] = F.trim) -> DataFrame:
    """(attr_id, object_type, object_id, attr_key, attr_value, attr_state) of the profiled concepts: known columns as rows, nulls left out.

    With ``gate`` only texts that are decided ALLOW have attributes. A value that its key does not allow is left out; of rows of one
    (object, key) the last value by the column ``order`` stays; without such a column, or of equal places in it, the greatest.
    """
    keys = [k for k in allowed if k in profile.columns]
    rows = profile.where(F.col("decision").eqNullSafe("ALLOW")) if gate else profile
    place = F.col(order) if order else F.lit(0)
    wide = rows.where("trim(unit_text) <> ''").select(F.sha2(canonical(F.col("unit_text")), 256).alias("object_id"), place.alias("place_"), *[F.col(k).cast("string").alias(k) for k in keys])
    valid = lambda k: F.col(k).isin(*allowed[k]) if allowed[k] else F.col(k).isNotNull()
    # a row an object, not a row a value, is shuffled
    once = wide.groupBy("object_id").agg(*[F.max(F.when(valid(k), F.struct("place_", k)))[k].alias(k) for k in keys])
    last = once.unpivot(["object_id"], keys, "attr_key", "attr_value").where("attr_value is not null").select(F.lit("concept").alias("object_type"), "object_id", "attr_key", "attr_value", F.lit("active").alias("attr_state"))
    return last.select(stable_attribute_id().alias("attr_id"), "*")


def attribute_declarations(profile: DataFrame, keys: list[str], object_type: str = "concept", id_col: str = "object_id") -> DataFrame:
    """(attr_id, object_type, object_id, attr_key, attr_value): the columns ``keys`` as rows, nulls left out; the id hashes the other fields."""
    wide = profile.select(F.col(id_col).alias("object_id"), *[F.col(k).cast("string").alias(k) for k in keys])
    long = wide.unpivot("object_id", keys, "attr_key", "attr_value").where("attr_value is not null").withColumn("object_type", F.lit(object_type))
    return long.select(component_hash("object_type", "object_id", "attr_key", "attr_value").alias("attr_id"), "object_type", "object_id", "attr_key", "attr_value")


def new_rows(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Rows of source whose key is not in target, one a key: what an insert-or-ignore appends."""
    return source.dropDuplicates(key).join(target.select(*key).distinct(), key, "left_anti")


def append_counts(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """One row: seen, inserted and duplicate counts of an append; they add up."""
    seen = source.agg(F.count(F.lit(1)).alias("seen"))
    added = new_rows(source, target, key).agg(F.count(F.lit(1)).alias("inserted"))
    return seen.crossJoin(added).withColumn("duplicates", F.col("seen") - F.col("inserted"))  # two single rows


def merged(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old with the rows of new in place of those of equal key."""
    return old.join(new.select(*key).distinct(), key, "left_anti").select(*old.columns).unionByName(new)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child whose key has no parent."""
    return child.join(parent.select(F.col(parent_key).alias("pk_")).distinct(), F.col(child_key) == F.col("pk_"), "left_anti")


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, n) of keys on more than one row."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def duplicate_summary(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row: groups of duplicate keys, their rows, and the rows in excess."""
    return duplicate_keys(rows, key).agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))


def uncovered(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Rows of left that no row of right matches on the null-safe key."""
    other = right.select(*[F.col(c).alias(f"{c}_") for c in key]).distinct()
    match = F.lit(True)
    for c in key:
        match = match & F.col(c).eqNullSafe(F.col(f"{c}_"))
    return left.join(other, match, "left_anti")


def coverage_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, n): distinct rows of one side only, both ways."""
    left = a.subtract(b).agg(F.count(F.lit(1)).alias("n")).select(F.lit("left_only").alias("side"), "n")
    return left.unionByName(b.subtract(a).agg(F.count(F.lit(1)).alias("n")).select(F.lit("right_only").alias("side"), "n"))


def attribute_conflicts(attributes: DataFrame) -> DataFrame:
    """(object_id, attr_key, n_values): keys with more than one value."""
    return attributes.groupBy("object_type", "object_id", "attr_key").agg(F.count_distinct("attr_value").alias("n_values")).where("n_values > 1")


def attribute_distribution(attributes: DataFrame) -> DataFrame:
    return attributes.groupBy("attr_key").agg(F.count(F.lit(1)).alias("n"))


def attribute_lists(attributes: DataFrame) -> DataFrame:
    """(object_id, attributes): the object's 'key=value' strings in order."""
    return attributes.groupBy("object_id").agg(F.array_sort(F.collect_list(F.concat_ws("=", "attr_key", "attr_value"))).alias("attributes"))


def pivoted(attributes: DataFrame, keys: list[str]) -> DataFrame:
    """One row an object with the values of ``keys`` as columns; one aggregation in place of a join a key."""
    return attributes.groupBy("object_id").agg(*[F.max(F.when(F.col("attr_key") == k, F.col("attr_value"))).alias(k) for k in keys])


def top_concepts_of_units(units: DataFrame, concepts: DataFrame, n: int = 100, offset: int = 0) -> DataFrame:
    """``top_concepts`` from the units: they are counted by text before they meet the concepts, so no unit is joined."""
    counted = units.groupBy("unit_text").agg(F.count(F.lit(1)).alias("n_instances"), F.count_distinct("asset_id").alias("n_assets"))
    return counted.join(concepts.select("unit_text"), "unit_text").orderBy(F.desc("n_instances"), "unit_text").offset(offset).limit(min(n, 10_000))


def top_concepts(instances: DataFrame, concepts: DataFrame, n: int = 100, offset: int = 0) -> DataFrame:
    """The concepts with most instances (ties by text), a page of at most 10,000."""
    counted = instances.groupBy("concept_id").agg(F.count(F.lit(1)).alias("n_instances"), F.count_distinct("asset_id").alias("n_assets"))
    return counted.join(concepts, "concept_id").select("unit_text", "n_instances", "n_assets").orderBy(F.desc("n_instances"), "unit_text").offset(offset).limit(min(n, 10_000))


def table_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, n) of several tables in one result."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_snapshot(rows: DataFrame, log: DataFrame, table: str) -> DataFrame:
    """Rows of the newest finished sync of a table; the sync id prunes partitions."""
    newest = log.where(F.col("source_table") == table).agg(F.max_by("sync_id", F.struct("finished_at", "sync_id")).alias("newest"))
    return rows.join(F.broadcast(newest), rows["sync_id"] == F.col("newest"), "left_semi")  # one row


def content_delta(rows: DataFrame, stored: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows whose content hash is new: the first of equal ones, none that is stored already."""
    hashed = rows.withColumn("content_hash", F.sha2(F.col(text_col), 256))
    first = Window.partitionBy("content_hash").orderBy(*[c for c in rows.columns if c != text_col])
    return hashed.join(stored.select("content_hash").distinct(), "content_hash", "left_anti").withColumn("r", F.row_number().over(first)).where("r = 1").drop("r")


def audit(**checks: DataFrame) -> DataFrame:
    """(check_name, status, violations): one row a check, of the rows that violate it."""
    out = None
    for name, bad in checks.items():
        row = bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), F.when(F.col("violations") == 0, "pass").otherwise("fail").alias("status"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


# --- presets over (concepts, attributes, instances) -----------------------------------------
def with_attribute(concepts: DataFrame, attributes: DataFrame, key: str, kind: str = "int") -> DataFrame:
    """concepts with the attribute ``key`` as a typed column; a value that is no such number is an error."""
    a = attributes.where(F.col("attr_key") == key).select(F.col("object_id").alias("oid_"), F.col("attr_value").cast(kind).alias(key))
    return concepts.join(a, F.col("concept_id") == F.col("oid_")).drop("oid_")


def paged(rows: DataFrame, order: list, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of at most 10,000 ordered rows."""
    return rows.orderBy(*order).offset(offset).limit(min(limit, 10_000))


def concepts_by(concepts: DataFrame, attributes: DataFrame, key: str, limit: int = 100, offset: int = 0) -> DataFrame:
    return paged(with_attribute(concepts, attributes, key).select("unit_text", key), [F.desc(key), "unit_text"], limit, offset)


def high_value_concepts(concepts: DataFrame, attributes: DataFrame, least_count: int = 10, least_paths: int = 5, limit: int = 100, offset: int = 0) -> DataFrame:
    """Frequent concepts on many paths, with the share of their dominant path where it is known; one aggregation in place of three joins."""
    value = lambda k, kind: F.max(F.when(F.col("attr_key") == k, F.col("attr_value"))).cast(kind).alias(k)
    wide = attributes.where(F.col("attr_key").isin("occurrence_count", "path_diversity", "dominant_path_ratio")).groupBy(F.col("object_id").alias("oid_")).agg(value("occurrence_count", "int"), value("path_diversity", "int"), value("dominant_path_ratio", "double"))
    wide = wide.where((F.col("occurrence_count") >= least_count) & (F.col("path_diversity") >= least_paths))
    found = concepts.join(wide, F.col("concept_id") == F.col("oid_")).select("unit_text", "occurrence_count", "path_diversity", "dominant_path_ratio")
    return paged(found, [F.desc("occurrence_count"), "unit_text"], limit, offset)


def concept_profile(concepts: DataFrame, attributes: DataFrame, text: str, limit: int = 100) -> DataFrame:
    one = concepts.where(F.col("unit_text") == text).select(F.col("concept_id").alias("object_id"))
    return paged(attributes.join(one, "object_id", "left_semi").select("attr_key", "attr_value", "attr_state"), ["attr_key", "attr_value"], limit)


def concept_instances(concepts: DataFrame, instances: DataFrame, text: str, limit: int = 100) -> DataFrame:
    one = concepts.where(F.col("unit_text") == text).select("concept_id")
    return paged(instances.join(one, "concept_id", "left_semi").select("asset_id", "path", "segment_index", "char_start", "char_end"), ["asset_id", "path", "segment_index", "char_start"], limit)


def table_stats(**tables: DataFrame) -> DataFrame:
    """One row of counts."""
    out = None
    for name, rows in tables.items():
        one = rows.agg(F.count(F.lit(1)).alias(f"{name}_count"))
        out = one if out is None else out.crossJoin(one)  # single rows
    return out


def sync_history(log: DataFrame, limit: int = 100) -> DataFrame:
    return paged(log.select("sync_id", "source_table", "record_count", "finished_at"), [F.desc("finished_at"), "sync_id", "source_table"], limit)


def concept_search(concepts: DataFrame, keyword: str, limit: int = 100) -> DataFrame:
    return paged(concepts.where(F.col("unit_text").ilike("%" + keyword.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%")).select("concept_id", "unit_text"), ["unit_text"], limit)


def enriched(hits: DataFrame, id_col: str, concepts: DataFrame, attributes: DataFrame, instances: DataFrame) -> DataFrame:
    """hits with their concept's text, instance count and sorted attributes; each side is aggregated before it is joined."""
    key = F.col(id_col)
    counts = instances.groupBy(F.col("concept_id").alias("i_")).agg(F.count(F.lit(1)).alias("instance_count"))
    lists = attributes.groupBy(F.col("object_id").alias("a_")).agg(F.array_sort(F.collect_list(F.concat_ws("=", "attr_key", "attr_value"))).alias("attributes"))
    texts = concepts.select(F.col("concept_id").alias("c_"), "unit_text")
    out = hits.join(texts, key == F.col("c_"), "left").join(counts, key == F.col("i_"), "left").join(lists, key == F.col("a_"), "left")
    return out.withColumn("instance_count", F.coalesce("instance_count", F.lit(0))).withColumn("attributes", F.coalesce("attributes", F.array().cast("array<string>"))).drop("c_", "i_", "a_")
