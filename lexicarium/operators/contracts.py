"""Contracts and ledgers: what a payload violates, as rows or arrays of errors; the state of runs, deliveries and tasks from their logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _labelled(rows: DataFrame, node: str | None, error: str) -> DataFrame:
    return rows.select("conversation_id", (F.col(node) if node else F.lit(None)).cast("string").alias("node_id"), F.lit(error).alias("error"))


def node_violations(nodes: DataFrame) -> DataFrame:
    """(conversation_id, node_id, error): what nodes (conversation_id, node_id, node_order, parent_id, child_ids) violate.

    Links are compared as rows (conversation, parent, child), so a conversation is never gathered. Errors of a node: repeated_node,
    self_reference, parent_missing, child_missing, repeated_child, not_listed (its parent does not list it) and other_parent (a listed
    child has another parent); of a conversation, without a node: node_order (not 0 to n - 1) and no_root.
    """
    known = nodes.select("conversation_id", "node_id").distinct()
    up = nodes.where("parent_id is not null").select("conversation_id", F.col("parent_id").alias("parent"), F.col("node_id").alias("child")).distinct()
    counted = nodes.select("conversation_id", F.col("node_id").alias("parent"), F.explode("child_ids").alias("child")).groupBy("conversation_id", "parent", "child").agg(F.count(F.lit(1)).alias("n"))
    down = counted.drop("n")
    there = lambda rows, end, how: rows.join(known.withColumnRenamed("node_id", end), ["conversation_id", end], how)
    edge = ["conversation_id", "parent", "child"]
    orders = nodes.groupBy("conversation_id", "node_order").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("parent_id").isNull()).alias("roots"))
    per = orders.groupBy("conversation_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"), F.min("node_order").alias("low"), F.max("node_order").alias("high"), F.sum("roots").alias("roots"))
    found = [
        _labelled(nodes.groupBy("conversation_id", "node_id").count().where("count > 1"), "node_id", "repeated_node"),
        _labelled(up.union(down).where("parent = child").distinct(), "child", "self_reference"),
        _labelled(there(up, "parent", "left_anti"), "child", "parent_missing"),
        _labelled(there(down, "child", "left_anti"), "parent", "child_missing"),
        _labelled(counted.where("n > 1"), "parent", "repeated_child"),
        _labelled(there(up.join(down, edge, "left_anti"), "parent", "left_semi"), "child", "not_listed"),
        _labelled(there(down.join(up, edge, "left_anti"), "child", "left_semi"), "parent", "other_parent"),
        _labelled(per.where("n <> d or low <> 0 or high <> n - 1"), None, "node_order"),
        _labelled(per.where("roots = 0"), None, "no_root"),
    ]
    return reduce(DataFrame.unionByName, found)


def annotation_errors(annotations: DataFrame, required: list[str], statuses: list[str]) -> DataFrame:
    """(annotation_id, errors) of annotations that break the contract: a required text is empty, an unknown resolution status, span or confidence out of bounds."""
    empty = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", f"missing_{c}") for c in required]
    span = F.coalesce((F.col("span_start") >= 0) & (F.col("span_end") > F.col("span_start")), F.lit(False))
    sure = F.coalesce(F.col("confidence").between(0, 1), F.lit(False))
    status = F.coalesce(F.col("resolution_status").isin(statuses), F.lit(False))
    errors = F.array_compact(F.array(*empty, F.when(~status, "resolution_status"), F.when(~span, "span"), F.when(~sure, "confidence")))
    return annotations.select("annotation_id", errors.alias("errors")).where(F.size("errors") > 0)


SOURCE_COORDINATE = ["asset_id", "path", "value_index", "source_value_sha1"]


def source_coordinates(units: DataFrame) -> DataFrame:
    """The distinct source values that units come from: what a later reader of the source is allowed to read."""
    return units.where("asset_id <> '' and path <> '' and value_index >= 0 and source_value_sha1 <> ''").select(*SOURCE_COORDINATE).distinct()


def access_manifest(units: DataFrame) -> DataFrame:
    """One row: allowed coordinates, assets and paths, and units whose coordinate is invalid."""
    allowed = source_coordinates(units)
    counts = allowed.agg(F.count(F.lit(1)).alias("coordinates"), F.count_distinct("asset_id").alias("assets"), F.count_distinct("path").alias("paths"))
    valid = F.coalesce(F.expr("asset_id <> '' and path <> '' and value_index >= 0 and source_value_sha1 <> ''"), F.lit(False))
    return counts.crossJoin(units.agg(F.count_if(~valid).alias("invalid")))  # two single rows


def authorized(values: DataFrame, allowed: DataFrame) -> DataFrame:
    """Source values whose coordinate is allowed and whose content is still the one that was allowed."""
    return values.join(allowed.select(*SOURCE_COORDINATE), SOURCE_COORDINATE, "left_semi")


def side_table_problems(side: DataFrame, canonical: DataFrame, key: str, payload: str) -> DataFrame:
    """(problem, n) keys: duplicate_key, canonical_missing, side_missing and payload_mismatch; one full join of rows a key."""
    s = side.groupBy(key).agg(F.count(F.lit(1)).alias("n_"), F.min(payload).alias("low_"), F.max(payload).alias("high_"))
    c = canonical.groupBy(key).agg(F.min(payload).alias("known_"), F.lit(1).alias("c_"))
    both = s.join(c, key, "full")
    differs = F.col("n_").isNotNull() & F.col("c_").isNotNull() & ~(F.col("low_").eqNullSafe(F.col("known_")) & F.col("high_").eqNullSafe(F.col("known_")))
    problems = F.array_compact(F.array(F.when(F.col("n_") > 1, "duplicate_key"), F.when(F.col("c_").isNull(), "canonical_missing"), F.when(F.col("n_").isNull(), "side_missing"), F.when(differs, "payload_mismatch")))
    return both.select(F.explode(problems).alias("problem")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def conservation(**stages: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(measure, input, output, reconciled): rows that went in and came out, by measure."""
    count = lambda rows, name: rows.agg(F.count(F.lit(1)).alias(name))
    lines = [count(a, "input").crossJoin(count(b, "output")).select(F.lit(name).alias("measure"), "input", "output") for name, (a, b) in stages.items()]  # single rows
    return reduce(DataFrame.unionByName, lines).withColumn("reconciled", F.col("input") == F.col("output"))


def forbidden_keys(nodes: DataFrame, words: list[str]) -> DataFrame:
    """(path, n): JSON paths that end in a forbidden key, letter case aside, at any depth, and how often they stand there."""
    key = F.lower(F.regexp_extract("path", r"([^/]+)$", 1))
    return nodes.where(key.isin([w.lower() for w in words])).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


# --- ledgers ---------------------------------------------------------------------------------
def run_states(log: DataFrame, order: list[str], ended: list[str]) -> DataFrame:
    """(run_id, first_at, last_at, events, state): a run's last event, which is its state when it ends the run, else running."""
    last = F.max_by("status", F.struct(*order))
    out = log.groupBy("run_id").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count(F.lit(1)).alias("events"), last.alias("last_"))
    return out.withColumn("state", F.when(F.col("last_").isin(ended), F.col("last_")).otherwise("running")).drop("last_")


def delivery_status(deliveries: DataFrame, index_events: DataFrame) -> DataFrame:
    """deliveries with the number of their index events and the last one's status (of equal event ids the greatest), not_requested without any."""
    last = index_events.groupBy(F.col("delivery_id").alias("d_")).agg(F.count(F.lit(1)).alias("n_"), F.max_by("status", F.struct("event_id", "status")).alias("last_"))
    out = deliveries.join(last, F.col("delivery_id") == F.col("d_"), "left")
    return out.withColumn("index_events", F.coalesce("n_", F.lit(0))).withColumn("index_status", F.coalesce("last_", F.lit("not_requested"))).drop("d_", "n_", "last_")


def resumed(tasks: DataFrame, revisions: DataFrame) -> DataFrame:
    """tasks with their head revision and the number of revisions; tasks without one keep null and 0."""
    head = revisions.groupBy(F.col("task_id").alias("t_")).agg(F.max("revision").alias("head"), F.count(F.lit(1)).alias("n_"))
    return tasks.join(head, F.col("task_id") == F.col("t_"), "left").withColumn("revisions", F.coalesce("n_", F.lit(0))).drop("t_", "n_")


def intake_units(rows: DataFrame, id_col: str, text_col: str, adapter: str, version: str, policy: str) -> DataFrame:
    """(id, unit_index, unit_id): the lines of a source as units; the id hashes source content, adapter, version, policy and index, so equal sources have equal units."""
    lines = rows.select(id_col, F.sha2(text_col, 256).alias("source_hash"), F.posexplode(F.split(text_col, "\n")).alias("unit_index", "line_"))
    parts: list[Column] = [F.col("source_hash"), F.lit(adapter), F.lit(version), F.lit(policy), F.col("unit_index").cast("string")]
    return lines.where("trim(line_) <> ''").select(id_col, "unit_index", F.sha2(F.concat_ws("|", *parts), 256).alias("unit_id"))


# --- messages, content parts and event times -------------------------------------------------
#: What the canonical form of a message allows.
ROLES = ("user", "assistant", "system", "tool", "developer", "unknown")
PART_TYPES = ("text", "image", "audio", "file", "tool_call", "tool_result", "code", "structured", "unknown")
RAW_TYPES = ("unix_seconds", "iso8601", "string", "integer", "decimal", "unknown")
SEMANTIC_STATUSES = ("verified", "unverified", "ambiguous", "invalid", "missing")
MAPPING_METHODS = ("direct", "renamed", "normalized", "derived_from_sequence", "synthesized_stable_id", "preserved_extension")
LOSS_STATUSES = ("lossless", "represented_in_extension", "degraded", "unmapped")

SOURCE_REF = "struct<source_file_id: string, source_path: string, source_index: bigint, source_id: string, source_value_sha256: string, mapping_method: string, loss_status: string>"
PART = f"struct<part_id: string, part_index: bigint, part_type: string, text: string, source_ref: {SOURCE_REF}>"
EVENT_TIME = f"struct<event_kind: string, raw_type: string, normalized_utc: string, semantic_status: string, source_ref: {SOURCE_REF}>"
#: A message of the canonical form, a row each.
MESSAGE = f"conversation_id string, node_id string, message_id string, role string, source_role string, content_type string, parts array<{PART}>, event_times array<{EVENT_TIME}>, source_ref {SOURCE_REF}"


def _absent(c: Column) -> Column:
    return F.coalesce(c == "", F.lit(True))


def _not_in(c: Column, allowed: tuple[str, ...]) -> Column:
    return ~F.coalesce(c.isin(*allowed), F.lit(False))


def source_ref_errors(ref: Column, label: str) -> list[Column]:
    """Errors of one source reference, null where there is none: no reference or file, a wrong index, digest, method or loss status."""
    sha = F.coalesce(ref["source_value_sha256"].rlike("^[0-9a-f]{64}$"), F.lit(False))
    tests = (("source_file", _absent(ref["source_file_id"])), ("source_path", ref["source_path"].isNull()), ("source_index", F.coalesce(ref["source_index"] < 0, F.lit(False))), ("source_sha256", ~sha), ("mapping_method", _not_in(ref["mapping_method"], MAPPING_METHODS)), ("loss_status", _not_in(ref["loss_status"], LOSS_STATUSES)))
    return [F.when(test, f"{label}.{name}") for name, test in tests]


def is_utc(c: Column) -> Column:
    """ISO-8601 text in UTC with Z."""
    return F.coalesce(c.rlike(r"^\d{4}-\d\d-\d\d([T ]\d\d(:\d\d(:\d\d(\.\d{1,6})?)?)?)?Z$") & F.try_to_timestamp(c).isNotNull(), F.lit(False))


def _all_of(items: Column, errors) -> Column:
    """The errors of every item of an array."""
    return F.flatten(F.transform(F.coalesce(items, F.array()), lambda x, i: F.array_compact(F.array(*errors(x, i)))))


def message_errors() -> Column:
    """Array of errors of a row of MESSAGE: each error once, with the part or event time meant by ``part`` or ``event_time``."""

    def part(p: Column, i: Column) -> list[Column]:
        lost = F.coalesce(p["part_type"] == "text", F.lit(False)) & p["text"].isNull()
        tests = (("part.part_id", _absent(p["part_id"])), ("part.part_index", ~F.coalesce(p["part_index"] == i, F.lit(False))), ("part.part_type", _not_in(p["part_type"], PART_TYPES)), ("part.text", lost))
        return [F.when(test, name) for name, test in tests] + source_ref_errors(p["source_ref"], "part")

    def event(e: Column, i: Column) -> list[Column]:
        bad = e["normalized_utc"].isNotNull() & ~is_utc(e["normalized_utc"])
        tests = (("event_time.event_kind", _absent(e["event_kind"])), ("event_time.raw_type", _not_in(e["raw_type"], RAW_TYPES)), ("event_time.normalized_utc", bad), ("event_time.semantic_status", _not_in(e["semantic_status"], SEMANTIC_STATUSES)))
        return [F.when(test, name) for name, test in tests] + source_ref_errors(e["source_ref"], "event_time")

    repeated = lambda items, key: F.coalesce(F.size(F.array_distinct(F.transform(items, key))) < F.size(items), F.lit(False))
    own = (
        ("message_id", _absent(F.col("message_id"))),
        ("role", _not_in(F.col("role"), ROLES)),
        ("source_role", _absent(F.col("source_role"))),
        ("content_type", _absent(F.col("content_type"))),
        ("parts", F.col("parts").isNull()),
        ("event_times", F.col("event_times").isNull()),
        ("repeated_part_id", repeated(F.col("parts"), lambda p: p["part_id"])),
        ("repeated_event_time", repeated(F.col("event_times"), lambda e: F.struct(e["event_kind"], e["source_ref"]))),
    )
    mine = F.array_compact(F.array(*[F.when(test, name) for name, test in own], *source_ref_errors(F.col("source_ref"), "message")))
    return F.array_distinct(F.concat(mine, _all_of(F.col("parts"), part), _all_of(F.col("event_times"), event)))


def message_violations(messages: DataFrame) -> DataFrame:
    """(conversation_id, node_id, message_id, error) of messages (columns of MESSAGE) that break the canonical form; a message_id on several rows, in any conversation, is ``repeated_message_id`` on each."""
    rows = messages.select("conversation_id", "node_id", "message_id", F.explode(message_errors()).alias("error"))
    twice = messages.where("message_id <> ''").groupBy("message_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("message_id").alias("m_"))
    again = messages.join(twice, F.col("message_id") == F.col("m_"), "left_semi").select("conversation_id", "node_id", "message_id", F.lit("repeated_message_id").alias("error"))
    return rows.unionByName(again)


def message_counts(messages: DataFrame) -> DataFrame:
    """One row: conversations, messages, content_parts, event_times."""
    total = lambda c: F.coalesce(F.sum(F.coalesce(F.size(c), F.lit(0))), F.lit(0))
    return messages.agg(F.count_distinct("conversation_id").alias("conversations"), F.count(F.lit(1)).alias("messages"), total("parts").alias("content_parts"), total("event_times").alias("event_times"))
