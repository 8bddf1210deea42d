"""Structure of JSON values: nodes with path patterns, statistics by path, string leaves, candidates for record arrays."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicarium.functions.text import dynamic_key

#: Nesting deeper than this is an error, not a silent cut.
MOST_DEPTH = 64


def json_nodes(rows: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, path, type, size, keys, text) of every node of JSON values; array positions stand as *, identifiers as **.

    A row a value or node is carried along; a round opens one more level as Spark's variants do and lets the levels before pass, so
    every value is parsed once in the whole plan. Rounds end with the deepest value, found beforehand on the objects and arrays alone.
    """
    level = rows.select(F.col(id_col).alias("id"), F.lit("").alias("path"), F.try_parse_json(json_col).alias("v")).where("v is not null")
    depth, inner = 0, level
    while not (inner := inner.where(_opens("v"))).isEmpty():
        depth += 1
        if depth == MOST_DEPTH:
            raise ValueError(f"JSON nested deeper than {MOST_DEPTH}")
        inner = inner.select(F.explode(_members("v", F.lit(""))).alias("m")).select("m.v")
    nodes = level.withColumn("open", F.lit(True))
    for _ in range(depth):
        own = F.array(F.struct("path", "v", F.lit(False).alias("open")))
        within = F.transform(_members("v", F.col("path")), lambda m: F.struct(m["path"].alias("path"), m["v"].alias("v"), F.lit(True).alias("open")))
        nodes = nodes.select("id", F.explode(F.when(F.col("open") & _opens("v"), F.concat(own, within)).otherwise(F.array(F.struct("path", "v", "open")))).alias("n")).select("id", "n.*")
    kind = F.schema_of_variant("v")
    name = F.when(_is("OBJECT"), "object").when(_is("ARRAY"), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("number")
    keys = F.when(F.col("type") == "object", F.map_keys(F.expr("cast(v as map<string, variant>)")))
    size = F.when(F.col("type") == "object", F.size("keys")).when(F.col("type") == "array", F.size(F.expr("cast(v as array<variant>)")))
    typed = nodes.select("id", "path", "v", name.alias("type")).withColumn("keys", keys)
    return typed.select("id", "path", "type", size.cast("long").alias("size"), "keys", F.when(F.col("type") == "string", F.expr("v::string")).alias("text"))


def _is(kind: str) -> Column:
    return F.schema_of_variant("v").startswith(kind)


def _opens(v: str) -> Column:
    """An object or array with members."""
    return F.when(_is("OBJECT"), F.size(F.expr(f"cast({v} as map<string, variant>)")) > 0).when(_is("ARRAY"), F.size(F.expr(f"cast({v} as array<variant>)")) > 0).otherwise(False)


def _members(v: str, path: Column) -> Column:
    """(path, v) of the members of an object or array."""
    fields = F.transform(F.map_entries(F.expr(f"cast({v} as map<string, variant>)")), lambda m: F.struct(F.concat(path, F.lit("/"), dynamic_key(m["key"])).alias("path"), m["value"].alias("v")))
    items = F.transform(F.expr(f"cast({v} as array<variant>)"), lambda x: F.struct(F.concat(path, F.lit("/*")).alias("path"), x.alias("v")))
    return F.when(_is("OBJECT"), fields).when(_is("ARRAY"), items)


def structure_report(nodes: DataFrame) -> DataFrame:
    """(path, type, seen, size_min, size_max, size_avg, keys): statistics of nodes by path pattern and type; sizes are key counts and array lengths.

    Nodes are read once: those of equal path, type and keys are added up first, and statistics and keys come from these sums.
    """
    alike = nodes.groupBy("path", "type", "keys").agg(F.count(F.lit(1)).alias("n"), F.count("size").alias("sized"), F.min("size").alias("low"), F.max("size").alias("high"), F.sum("size").alias("total"))
    by_key = alike.select("*", F.posexplode_outer("keys").alias("at", "k"))
    once = lambda c: F.when(F.coalesce("at", F.lit(0)) == 0, F.col(c))
    by_key = by_key.groupBy("path", "type", dynamic_key(F.col("k")).alias("k")).agg(F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(once(c)).alias(c) for c in ("n", "sized", "total")])
    keys = F.slice(F.array_sort(F.collect_set("k")), 1, 50)
    whole = by_key.groupBy("path", "type").agg(F.sum("n").alias("seen"), F.min("low").alias("size_min"), F.max("high").alias("size_max"), F.round(F.try_divide(F.sum("total"), F.sum("sized")), 3).alias("size_avg"), keys.alias("keys"))
    return whole.withColumn("keys", F.when(F.size("keys") > 0, F.col("keys")))


def string_leaves(nodes: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """(id, path, text) of the string values, of the paths that match a pattern where patterns are given (* one part, ** any part)."""
    leaves = nodes.where("type = 'string'").select("id", "path", "text")
    if patterns is None:
        return leaves
    compiled = "|".join("^" + "/".join("[^/]+" if part in ("*", "**") else re.escape(part) for part in pattern.split("/")) + "$" for pattern in patterns)
    return leaves.where(F.col("path").rlike(compiled))


def record_arrays(nodes: DataFrame, least: float = 0.8) -> DataFrame:
    """(path, items, object_share, confidence) of arrays whose items are mostly objects; confidence by how alike their key sets are (common keys of all keys)."""
    items = nodes.where("path like '%/*'")
    alike = items.where("type = 'object'").groupBy("path").agg(F.array_distinct(F.flatten(F.collect_set("keys"))).alias("any_"), F.count(F.lit(1)).alias("objects"))
    held = items.where("type = 'object'").select("path", F.explode("keys").alias("k")).groupBy("path", "k").agg(F.count(F.lit(1)).alias("n"))
    common = held.join(alike.select("path", "objects"), "path").where("n = objects").groupBy("path").agg(F.count(F.lit(1)).alias("common"))
    counted = items.groupBy("path").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("type") == "object").alias("objects"))
    out = counted.join(alike.select("path", "any_"), "path").join(common, "path", "left")
    share, same = F.col("objects") / F.col("items"), F.coalesce("common", F.lit(0)) / F.greatest(F.size("any_"), F.lit(1))
    return out.where(share >= least).select("path", "items", F.round(share, 6).alias("object_share"), F.when(same >= 0.8, "high").when(same >= 0.5, "medium").otherwise("low").alias("confidence"))


#: Keys of an object that the statistics name: the first in order of names.
MOST_KEYS = 50
#: (path, type) entries that a task holds before it passes partial sums on.
MOST_ENTRIES = 50_000
_UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)


def _type_of(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    return {dict: "object", list: "array", str: "string"}.get(type(value), "number")


class _Entry:
    """What one (path, type) has added up to in a task."""

    __slots__ = ("children", "keys", "largest", "least", "seen", "total")

    def __init__(self):
        self.seen, self.least, self.largest, self.total, self.children, self.keys = 0, None, None, 0, {}, set()

    def add(self, size: int | None, children: list[str], keys: list[str]) -> None:
        self.seen += 1
        if size is not None:
            self.least = size if self.least is None else min(self.least, size)
            self.largest = size if self.largest is None else max(self.largest, size)
            self.total += size
        for child in children:
            self.children[child] = self.children.get(child, 0) + 1
        self.keys.update(keys)
        if len(self.keys) > 20 * MOST_KEYS:
            self.keys = set(sorted(self.keys)[:MOST_KEYS])


def _walk(value, entries: dict) -> None:
    """Add every node of a value to its entry; a stack of its own, so depth is no limit here."""
    stack = [("", value)]
    while stack:
        path, node = stack.pop()
        kind = _type_of(node)
        entry = entries.get((path, kind))
        if entry is None:
            entry = entries[(path, kind)] = _Entry()
        if kind == "object":
            keys = ["**" if _UUID.fullmatch(k) else k for k in node]
            entry.add(len(node), [_type_of(v) for v in node.values()], keys)
            stack.extend((f"{path}/{k}", v) for k, v in zip(keys, node.values(), strict=True))
        elif kind == "array":
            entry.add(len(node), [_type_of(v) for v in node], [])
            stack.extend((f"{path}/*", v) for v in node)
        else:
            entry.add(None, [], [])


def structure_statistics(rows: DataFrame, json_col: str) -> DataFrame:
    """(path, type, seen, size_min, size_max, size_avg, child_types, keys) of JSON texts, in one job.

    Each task walks its values once and adds every node to the entry of its path pattern and type; what tasks have added up to
    merges by sums, least and greatest values, so the shuffle carries a row an entry and task, whatever the number of values.
    ``child_types`` maps the types of an object's or array's members to their counts, ``keys`` are an object's first 50 in order.
    Texts that are no JSON are counted as path "" of type ``invalid``; nulls are not counted.
    """
    import json

    import pandas as pd

    def flushed(entries: dict) -> pd.DataFrame:
        out = []
        for (path, kind), e in entries.items():
            out.append((path, kind, None, None, e.seen, e.least, e.largest, e.total))
            out += [(path, kind, child, None, n, None, None, 0) for child, n in e.children.items()]
            out += [(path, kind, None, key, 0, None, None, 0) for key in sorted(e.keys)[:MOST_KEYS]]
        entries.clear()
        return pd.DataFrame(out, columns=["path", "type", "child", "key", "n", "least", "largest", "total"]).astype({"least": "Int64", "largest": "Int64"})

    def count(batches):
        entries: dict = {}
        for batch in batches:
            for text in batch[json_col]:
                try:
                    _walk(json.loads(text), entries)
                except (ValueError, RecursionError):
                    entries.setdefault(("", "invalid"), _Entry()).add(None, [], [])
                if len(entries) > MOST_ENTRIES:
                    yield flushed(entries)
        yield flushed(entries)

    partial = rows.where(F.col(f"`{json_col}`").isNotNull()).select(F.col(f"`{json_col}`").alias(json_col)).mapInPandas(count, "path string, type string, child string, key string, n long, least long, largest long, total long")
    merged = partial.groupBy("path", "type", "child", "key").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("largest").alias("largest"), F.sum("total").alias("total"))
    own, is_child, is_key = F.col("child").isNull() & F.col("key").isNull(), F.col("child").isNotNull(), F.col("key").isNotNull()
    children = F.map_from_entries(F.array_sort(F.collect_list(F.when(is_child, F.struct("child", "n")))))  # a row a type
    keys = F.slice(F.array_sort(F.collect_set(F.when(is_key, F.col("key")))), 1, MOST_KEYS)
    out = merged.groupBy("path", "type").agg(F.sum(F.when(own, F.col("n"))).alias("seen"), F.max("least").alias("size_min"), F.max("largest").alias("size_max"), F.sum("total").alias("total_"), children.alias("child_types"), keys.alias("keys"))
    sized = F.col("type").isin("object", "array")
    average = F.when(sized, F.round(F.col("total_") / F.col("seen"), 3))
    return out.select("path", "type", "seen", "size_min", "size_max", average.alias("size_avg"), F.when(sized, F.col("child_types")).alias("child_types"), F.when(F.col("type") == "object", F.col("keys")).alias("keys"))


def structure_gate(statistics: DataFrame, contract: list[tuple[str, list[str], bool]]) -> DataFrame:
    """(path, type, problem, n): where ``structure_statistics`` and a contract of (path pattern, allowed types, required) differ, at every depth.

    ``unknown_field``: a path that the contract does not name (n nodes); ``unexpected_type``: a named path with another type;
    ``missing``: a required field that n of its parent objects lack (all of them if it never occurs; 1 for the root).
    """
    spark = statistics.sparkSession
    rules = spark.createDataFrame([(p, t, r, p.rsplit("/", 1)[0] if p else None) for p, t, r in contract], "path string, types array<string>, required boolean, parent string")
    rules = F.broadcast(rules)  # the contract, given by the caller as a list
    met = statistics.join(rules.select("path", "types"), "path", "left")
    problem = F.when(F.col("types").isNull(), "unknown_field").when(~F.array_contains("types", F.col("type")), "unexpected_type")
    found = met.select("path", "type", problem.alias("problem"), F.col("seen").alias("n")).where("problem is not null")
    seen = statistics.groupBy("path").agg(F.sum("seen").alias("held"))
    objects = statistics.where("type = 'object'").select(F.col("path").alias("parent"), F.col("seen").alias("parents"))
    asked = rules.where("required").join(seen, "path", "left").join(objects, "parent", "left")
    lack = F.when(F.col("parent").isNull(), F.when(F.coalesce("held", F.lit(0)) == 0, 1).otherwise(0)).otherwise(F.coalesce("parents", F.lit(0)) - F.coalesce("held", F.lit(0)))
    missing = asked.select("path", F.lit(None).cast("string").alias("type"), F.lit("missing").alias("problem"), lack.cast("long").alias("n")).where("n > 0")
    return found.unionByName(missing)


def extensions(json_text: Column, known: list[str]) -> Column:
    """Map of an object's fields that are not known, with their JSON; empty without any, null where the text is no object."""
    return F.map_filter(F.from_json(json_text, "map<string,string>"), lambda k, v: ~k.isin(*known) if known else F.lit(True))
