"""Registered queries of hierarchies, byte-budget batches, array files, closures, graph merges and append ledgers, each beside its DuckDB SQL (where SQL can state it)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexicarium.functions import text
from lexicarium.operators import anchors, closure, contracts, graphs, hierarchy, sequences, structure, units
from lexicarium.operators.tables import cut, folder
from lexicarium.plans.queries import UNITS, _units, query, table
from lexicarium.sources import graph_store, json_arrays, published
from lexicarium.streaming import ledger


def _scratch(spark, name: str) -> str:
    return f"{folder(spark)}/lexicarium/{name}-{uuid.uuid4().hex}"


# --- hierarchies with several parents ------------------------------------------------------------
HIERARCHY = """WITH RECURSIVE steps AS (SELECT user_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt, json_extract_string(props, '$.k') AS k FROM events),
e0 AS (SELECT 'u:' || user_id AS p, 't:' || event_type AS c, count(*) AS w FROM events GROUP BY ALL
UNION ALL SELECT 't:' || event_type, 't:' || nxt, count(*) FROM steps WHERE nxt IS NOT NULL GROUP BY ALL
UNION ALL SELECT 't:' || event_type, 'k:' || k, count(*) FROM steps WHERE k IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'n:' || c_nationkey, 'u:' || c_custkey, 1 FROM customer),
reg AS (SELECT 'u:' || c_custkey AS node FROM customer UNION SELECT 't:' || event_type FROM events UNION SELECT 'k:' || k FROM steps WHERE k IS NOT NULL UNION SELECT 'n:' || n_nationkey FROM nation WHERE n_nationkey > 0),
used AS (SELECT * FROM e0 WHERE p IN (SELECT node FROM reg) AND c IN (SELECT node FROM reg)),
e AS (SELECT p, c, max(w) AS w FROM used WHERE p <> c AND (w >= 2 OR p LIKE 'n:%') GROUP BY p, c),
reach AS (SELECT p, c FROM e WHERE p LIKE 't:%' UNION SELECT r.p, e.c FROM reach r JOIN e ON r.c = e.p),
cyc AS (SELECT a.p, a.c FROM reach a JOIN reach b ON a.p = b.c AND a.c = b.p),
back AS (SELECT p, c FROM e WHERE c <= p AND (p, c) IN (SELECT p, c FROM cyc)),
dag AS (SELECT p, c FROM e WHERE (p, c) NOT IN (SELECT p, c FROM back)),
d AS (SELECT p AS node, 0 AS depth FROM dag WHERE p NOT IN (SELECT c FROM dag) UNION SELECT dag.c, d.depth + 1 FROM d JOIN dag ON dag.p = d.node),
depths AS (SELECT n.node, coalesce(max(d.depth), 0) AS depth, n.node IN (SELECT p FROM cyc) AS on_cycle FROM (SELECT node FROM reg UNION SELECT p FROM e UNION SELECT c FROM e) n LEFT JOIN d ON d.node = n.node GROUP BY n.node)
"""


def _event_hierarchy(spark, sf_dir):
    """(edges, register): nations above customers above the types of their events above later types and property values; types form cycles."""
    e, c = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    steps = e.withColumn("nxt", F.lead("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).withColumn("k", F.get_json_object("props", "$.k"))
    name = lambda mark, col: F.concat(F.lit(f"{mark}:"), F.col(col).cast("string"))
    pairs = [(e, name("u", "user_id"), name("t", "event_type")), (steps.where("nxt is not null"), name("t", "event_type"), name("t", "nxt")), (steps.where("k is not null"), name("t", "event_type"), name("k", "k"))]
    edges = c.select(name("n", "c_nationkey").alias("parent"), name("u", "c_custkey").alias("child"), F.lit(2).cast("long").alias("weight"))
    for rows, parent, child in pairs:
        edges = edges.unionByName(rows.select(parent.alias("parent"), child.alias("child")).groupBy("parent", "child").agg(F.count(F.lit(1)).alias("weight")))
    nation = table(spark, sf_dir, "nation").where("n_nationkey > 0")
    nodes = [c.select(name("u", "c_custkey")), e.select(name("t", "event_type")), steps.where("k is not null").select(name("k", "k")), nation.select(name("n", "n_nationkey"))]
    register = nodes[0].toDF("node")
    for n in nodes[1:]:
        register = register.union(n)
    return edges, register.distinct()


@query(HIERARCHY + "SELECT node, CAST(depth AS INTEGER) AS depth, on_cycle FROM depths")
def layered_hierarchy(spark, sf_dir):
    edges, register = _event_hierarchy(spark, sf_dir)
    return hierarchy.hierarchy_depths(register, hierarchy.pruned_hierarchy(edges, register, least=2))[0]


@query(
    HIERARCHY
    + """SELECT (SELECT count(*) FROM e0) AS rows_read, (SELECT count(*) FROM used) AS rows_used, (SELECT count(*) FROM e) AS edges_kept, (SELECT count(*) FROM depths) AS nodes, CAST((SELECT max(depth) FROM depths) AS INTEGER) AS max_depth,
(SELECT count(*) FROM depths WHERE on_cycle) AS nodes_on_cycles, (SELECT count(*) FROM back) AS edges_cut, (SELECT count(*) FROM e0) - (SELECT count(*) FROM used) AS rows_dropped, (SELECT count(*) FROM back) > 0 AS cycle_detected"""
)
def hierarchy_report(spark, sf_dir):
    edges, register = _event_hierarchy(spark, sf_dir)
    kept = hierarchy.pruned_hierarchy(edges, register, least=2)
    return hierarchy.hierarchy_report(edges, register, kept, *hierarchy.hierarchy_depths(register, kept))


# --- batches of a byte budget --------------------------------------------------------------------
BUDGET = 65_536
BATCHES = f"""WITH RECURSIVE items AS (SELECT source, doc_id, strlen(coalesce(text, '')) AS size, coalesce(text, '') AS text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM documents),
s AS (SELECT *, CAST(sum(size + 1) OVER (PARTITION BY source ORDER BY i) AS BIGINT) AS e FROM items),
g AS (SELECT source, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS base FROM s WHERE i = 0
UNION ALL SELECT source, i, base FROM (SELECT g.source, min(s.i) AS i, min(s.e - s.size - 1) AS base FROM g JOIN s ON s.source = g.source AND s.i > g.i AND s.e - g.base + 2 > {BUDGET} GROUP BY g.source)),
batches AS (SELECT s.*, CAST(count(g.i) OVER (PARTITION BY s.source ORDER BY s.i) - 1 AS BIGINT) AS batch FROM s LEFT JOIN g ON g.source = s.source AND g.i = s.i)
"""


def _batched(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return d, sequences.greedy_batches(d, ["source"], "doc_id", F.octet_length("text"), BUDGET)


@query(BATCHES + "SELECT source, doc_id, batch FROM batches")
def greedy_batches(spark, sf_dir):
    """The documents of each source as consecutive batches of at most 64 KB."""
    return _batched(spark, sf_dir)[1]


@query(BATCHES + "SELECT source, batch, min(doc_id) AS first_index, max(doc_id) AS last_index, count(*) AS items, CAST(sum(size) + count(*) + 1 AS BIGINT) AS bytes, sha256('[' || string_agg(text, ',' ORDER BY doc_id) || ']') AS sha256 FROM batches GROUP BY source, batch")
def batch_manifest(spark, sf_dir):
    d, b = _batched(spark, sf_dir)
    return sequences.batch_manifest(d.join(b, ["source", "doc_id"]), ["source"], "doc_id", F.col("text"))


@query("SELECT source, count(*) AS items, count(*) FILTER (NOT (source = 'src1' AND n_chars < 300)) AS found, count(*) FILTER (source = 'src1' AND n_chars < 300) = 0 AS complete FROM documents GROUP BY source")
def batch_reconstruction(spark, sf_dir):
    """Batches written and read back against their source, with a fault: short documents of one source are lost on the way."""
    d, b = _batched(spark, sf_dir)
    path = _scratch(spark, "batches")
    lossy = d.join(table(spark, sf_dir, "documents").where("source = 'src1' and n_chars < 300").select("source", "doc_id"), ["source", "doc_id"], "left_anti")
    lossy.join(b, ["source", "doc_id"]).select("source", "batch", "doc_id", "text").write.parquet(path)
    return sequences.reconstruction(d, spark.read.parquet(path), ["source"], "doc_id", "text")


# --- array files ---------------------------------------------------------------------------------
def _array_files(spark, sf_dir):
    path = _scratch(spark, "arrays")
    json_arrays.write_arrays(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return path


@query("SELECT page_id, url, sha256(html) AS html_sha256 FROM pages")
def array_round_trip(spark, sf_dir):
    """The pages written as JSON arrays and read back by byte ranges of 1 MB."""
    items = json_arrays.root_array(spark, _array_files(spark, sf_dir), chunk_bytes=1 << 20, unique_fields=True)
    row = F.from_json("json", "page_id long, url string, html string").alias("r")
    return items.select(row).select("r.page_id", "r.url", F.sha2("r.html", 256).alias("html_sha256"))


@query("SELECT count(*) AS items, CAST(sum(page_id) AS BIGINT) AS ids FROM pages")
def array_inspection(spark, sf_dir):
    """Items of all array files, and the ids of items counted as the files number them: every file's last number is one less than its items."""
    items = json_arrays.numbered(json_arrays.root_array(spark, _array_files(spark, sf_dir), chunk_bytes=1 << 20), 1 << 20)
    per = items.groupBy("path").agg(F.max("index").alias("last"), F.sum(F.get_json_object("json", "$.page_id").cast("long")).alias("ids"))
    return per.agg(F.sum(F.col("last") + 1).alias("items"), F.sum("ids").alias("ids"))


# --- closures ------------------------------------------------------------------------------------
CLOSURE = """WITH RECURSIVE a AS (SELECT event_id, user_id, event_type, value, props, lag(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS old FROM events),
refs AS (SELECT 'annotation' AS kind, CAST(event_id AS VARCHAR) AS id, 'SUPERSEDES' AS relation, 'annotation' AS to_kind, CAST(old AS VARCHAR) AS to_id FROM a WHERE old IS NOT NULL
UNION ALL SELECT 'annotation', CAST(event_id AS VARCHAR), 'ANCHORED_AT', 'anchor', CAST(user_id AS VARCHAR) FROM a
UNION ALL SELECT 'attribute', 'k' || event_id, 'ATTRIBUTE_OF', 'annotation', CAST(event_id AS VARCHAR) FROM a WHERE props IS NOT NULL),
objects AS (SELECT 'annotation' AS kind, CAST(event_id AS VARCHAR) AS id, event_type || ' ' || coalesce(props, '') AS body FROM a WHERE NOT (event_type = 'view' AND value < 20)
UNION ALL SELECT 'anchor', CAST(c_custkey AS VARCHAR), c_name FROM customer UNION ALL SELECT 'attribute', 'k' || event_id, props FROM a WHERE props IS NOT NULL),
c AS (SELECT 'attribute' AS kind, 'k' || event_id AS id, 0 AS hops FROM a WHERE props IS NOT NULL AND event_type IN ('error', 'view') UNION SELECT r.to_kind, r.to_id, c.hops + 1 FROM c JOIN refs r ON r.kind = c.kind AND r.id = c.id),
closed AS (SELECT kind, id, min(hops) AS hops, (kind, id) NOT IN (SELECT kind, id FROM objects) AS missing FROM c GROUP BY kind, id)
"""


def _closed(spark, sf_dir):
    """(closure, references, bodies): attributes of errors and views, their annotations, what those supersede, and the anchors; cheap views are lost on purpose."""
    from lexicarium.operators.retrieval import annotations_of

    e = table(spark, sf_dir, "events")
    a = annotations_of(e).join(e.select(F.col("event_id").alias("annotation_id"), "value"), "annotation_id")
    named = lambda c: F.col(c).cast("string")
    ref = lambda rows, kind, id_, relation, to_kind, to_id: rows.select(F.lit(kind).alias("kind"), id_.alias("id"), F.lit(relation).alias("relation"), F.lit(to_kind).alias("to_kind"), to_id.alias("to_id"))
    attribute = F.concat(F.lit("k"), named("annotation_id"))
    held = a.where("body is not null")
    refs = ref(a.where("supersedes is not null"), "annotation", named("annotation_id"), "SUPERSEDES", "annotation", named("supersedes")).unionByName(ref(a, "annotation", named("annotation_id"), "ANCHORED_AT", "anchor", named("anchor_id"))).unionByName(ref(held, "attribute", attribute, "ATTRIBUTE_OF", "annotation", named("annotation_id")))
    kept = a.where("not (annotation_type = 'view' and value < 20)").select(F.lit("annotation").alias("kind"), named("annotation_id").alias("id"), F.concat_ws(" ", "annotation_type", F.coalesce("body", F.lit(""))).alias("body"))
    anchors = table(spark, sf_dir, "customer").select(F.lit("anchor").alias("kind"), named("c_custkey").alias("id"), F.col("c_name").alias("body"))
    bodies = kept.unionByName(anchors).unionByName(held.select(F.lit("attribute").alias("kind"), attribute.alias("id"), "body"))
    selected = held.where("annotation_type in ('error', 'view')").select(F.lit("attribute").alias("kind"), attribute.alias("id"))
    return closure.closure(selected, refs, bodies), refs, bodies


@query(CLOSURE + "SELECT kind, id, CAST(hops AS INTEGER) AS hops, missing FROM closed")
def reference_closure(spark, sf_dir):
    return _closed(spark, sf_dir)[0]


@query(
    CLOSURE
    + """SELECT 'object' AS record_type, kind, id, body IS NULL AS bodiless FROM closed LEFT JOIN objects USING (kind, id)
UNION ALL SELECT DISTINCT 'relation', r.kind, r.id, false FROM refs r JOIN closed x ON r.kind = x.kind AND r.id = x.id JOIN closed y ON r.to_kind = y.kind AND r.to_id = y.id WHERE relation <> 'ANCHORED_AT'"""
)
def replay_records(spark, sf_dir):
    closed, refs, bodies = _closed(spark, sf_dir)
    records = closure.replay_records(closed, bodies, refs).where(F.coalesce(F.get_json_object("json", "$.relation") != "ANCHORED_AT", F.lit(True)))
    return records.select("record_type", "kind", "id", ((F.col("record_type") == "object") & F.get_json_object("json", "$.body").isNull()).alias("bodiless"))


# --- graph merges --------------------------------------------------------------------------------
MERGED = """, parts AS (SELECT *, CASE WHEN path LIKE '%/en' OR path LIKE '%/de' THEN 1 ELSE 2 END AS b FROM units),
texts AS (SELECT b, trim(unit_text) AS t FROM parts GROUP BY ALL HAVING count(*) >= 2),
w AS (SELECT b, unit_text AS src, lead(unit_text) OVER (PARTITION BY asset_id, path, value_index, segment_index ORDER BY sentence_index, char_start, char_end) AS dst FROM parts),
ed AS (SELECT b, src, dst, count(*) AS weight FROM w WHERE dst IS NOT NULL AND src <> dst GROUP BY ALL),
ok AS (SELECT * FROM ed WHERE src IN (SELECT t FROM texts x WHERE x.b <= ed.b) AND dst IN (SELECT t FROM texts x WHERE x.b <= ed.b))
"""


@query(UNITS + MERGED + "SELECT src, dst, arg_max(weight, b) AS weight, 'batch' || min(b) AS created_in, 'batch' || max(b) AS synced_in FROM ok GROUP BY src, dst")
def graph_merge(spark, sf_dir):
    """Adjacency of English and German documents merged into an empty graph, then that of all others, then the second batch once more."""
    u, _ = cut(_units(spark, sf_dir).drop("unit_id"))  # split once
    first = F.coalesce(F.col("path").endswith("/en") | F.col("path").endswith("/de"), F.lit(False))
    store = graph_store.GraphStore(spark, _scratch(spark, "graph"), buckets=16)
    # adjacency goes by short keys; only edges between nodes of the store get their texts
    near = lambda part: graphs.adjacency_edges(part.withColumn("unit_text", graphs.short_key("unit_text")))
    for name, part in (("batch1", u.where(first)), ("batch2", u.where(~first))):
        nodes, _ = cut(graph_store.unit_nodes(part, least=2))
        store.merge_nodes(nodes, name)
        edges, _ = cut(graphs.named_edges(near(part), store.nodes.read().select(F.col("node_id").alias("node"))).withColumn("kind", F.lit("ADJACENT_TO")))
        store.merge_edges(edges, name, "StructuralUnit", "StructuralUnit")
    store.merge_nodes(nodes, name)
    store.merge_edges(edges, name, "StructuralUnit", "StructuralUnit")
    if not store.verified():
        raise ValueError("the graph read back differs from its manifests")
    return store.edges.read().select("src", "dst", "weight", "created_in", "synced_in")


CONVERSATION_ROWS = """WITH r AS (SELECT CAST(conv_id AS VARCHAR) AS a, turn, role, text, conv_id || ':' || turn AS node, lag(conv_id || ':' || turn) OVER (PARTITION BY conv_id ORDER BY turn) AS parent FROM conversations),
reg AS (SELECT trim(text) AS t FROM conversations GROUP BY 1 HAVING count(*) >= 2)
"""


@query(
    CONVERSATION_ROWS
    + """SELECT DISTINCT 'HAS_NODE' AS kind, a AS src, a || '::' || node AS dst FROM r UNION ALL SELECT DISTINCT 'PARENT_OF', a || '::' || parent, a || '::' || node FROM r WHERE parent IS NOT NULL
UNION ALL SELECT DISTINCT 'CONTAINS_UNIT', a || '::' || node, trim(text) FROM r WHERE role <> 'system' AND trim(text) <> '' AND trim(text) IN (SELECT t FROM reg)"""
)
def hierarchy_projection(spark, sf_dir):
    """Conversations as graph edges; system turns stand outside the content parts, and only texts that occur twice are registered."""
    c = table(spark, sf_dir, "conversations")
    nodes = graphs.conversation_nodes(c).withColumn("conversation_id", F.col("asset_id"))
    path = F.when(F.col("role") == "system", "/mapping/*/metadata").otherwise("/mapping/*/message/content/parts/0")
    rows = nodes.select("asset_id", "conversation_id", "node_id", "parent_id", path.alias("path"), F.col("text").alias("unit_text"))
    register = c.groupBy(F.trim("text").alias("unit_text")).count().where("count >= 2")
    return graph_store.hierarchy_edges(rows, register).select("kind", "src", "dst")


# --- published tables and appends ----------------------------------------------------------------
@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE c_mktsegment END AS segment, CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS version FROM customer")
def published_merge(spark, sf_dir):
    """Customers published, then those in debt merged over them: only touched buckets are written, and the first version stays readable."""
    c = table(spark, sf_dir, "customer")
    t = published.PublishedTable(spark, _scratch(spark, "customers"), ["c_custkey"], buckets=8)
    t.replace(c.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.lit(1).alias("version")))
    t.merge(c.where("c_acctbal < 0").select("c_custkey", F.lit("debt").alias("segment"), F.lit(2).alias("version")))
    if t.read(1).where("version <> 1").count():
        raise ValueError("an archived version changed")
    return t.read()


@query()
def append_ledger(spark, sf_dir):
    """Events as requests to their users' ledgers, answered by keyed state over a stream (no SQL: every answer depends on those before it; a test holds it to a plain fold).

    A third of the requests carry a stale base revision, some repeat an earlier request with the same or other content, some supersede an
    annotation of another type.
    """
    e = table(spark, sf_dir, "events")
    own = Window.partitionBy("user_id").orderBy("ts", "event_id")
    place = F.row_number().over(own) - 1
    r = e.select(
        F.col("user_id").cast("string").alias("anchor_id"),
        F.col("event_type").alias("producer_id"),
        F.when(F.col("value") < 30, F.concat(F.lit("again-"), "event_type")).otherwise(F.col("event_id").cast("string")).alias("request_id"),
        F.when(place % 3 == 2, F.lit(0)).otherwise(F.floor(place / 3)).cast("long").alias("base_revision"),
        F.col("event_id").cast("string").alias("annotation_id"),
        F.col("event_type").alias("annotation_type"),
        F.when(F.col("value") > 60, F.lag("event_id").over(own)).cast("string").alias("supersedes"),
        F.sha2(F.when(F.col("value") < 15, F.lit("same")).otherwise(F.col("props")), 256).alias("content_hash"),
        F.col("ts").alias("request_at"),
    )
    root = _scratch(spark, "ledger")
    r.write.parquet(f"{root}/requests")
    stream = ledger.folder_stream(spark, f"{root}/requests", spark.read.parquet(f"{root}/requests").schema)
    ledger.append(stream, f"{root}/answers", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/answers")


# --- structure of JSON values, running intervals -------------------------------------------------
def _event_statistics(spark, sf_dir):
    """Structure of events as JSON: errors carry a detail that the contract does not know, cheap events have no props, purchases a number as tag."""
    e = table(spark, sf_dir, "events")
    props = F.when(F.col("value") >= 20, F.from_json("props", "k long"))
    detail = F.when(F.col("event_type") == "error", F.struct(F.struct("user_id").alias("at")))
    tags = F.when(F.col("event_type") == "purchase", F.to_json(F.array("user_id"))).otherwise(F.to_json(F.array("event_type", F.col("user_id").cast("string"))))
    whole = F.to_json(F.struct(F.col("event_type").alias("kind"), props.alias("props"), detail.alias("detail")))
    both = F.concat(F.expr("left(j_, length(j_) - 1)"), F.lit(',"tags":'), tags, F.lit("}"))
    return structure.structure_statistics(e.withColumn("j_", whole).select(both.alias("json")), "json")


STRUCTURE = """WITH e AS (SELECT event_type, user_id, value >= 20 AS has, event_type = 'error' AS err, event_type = 'purchase' AS buy FROM events),
t AS (SELECT count(*) AS n, count(*) FILTER (has) AS props, count(*) FILTER (err) AS errs, count(*) FILTER (buy) AS buys, min(2 + has::INT + err::INT) AS lo, max(2 + has::INT + err::INT) AS hi, sum(2 + has::INT + err::INT) AS total FROM e),
stats AS (SELECT '' AS path, 'object' AS type, n AS seen, lo AS size_min, hi AS size_max, total AS size_sum, ['array:' || n, 'object:' || (props + errs), 'string:' || n] AS child_types FROM t
UNION ALL SELECT '/kind', 'string', n, NULL, NULL, NULL, NULL FROM t UNION ALL SELECT '/props', 'object', props, 1, 1, props, ['number:' || props] FROM t UNION ALL SELECT '/props/k', 'number', props, NULL, NULL, NULL, NULL FROM t
UNION ALL SELECT '/detail', 'object', errs, 1, 1, errs, ['object:' || errs] FROM t UNION ALL SELECT '/detail/at', 'object', errs, 1, 1, errs, ['number:' || errs] FROM t UNION ALL SELECT '/detail/at/user_id', 'number', errs, NULL, NULL, NULL, NULL FROM t
UNION ALL SELECT '/tags', 'array', n, 1, 2, 2 * n - buys, ['number:' || buys, 'string:' || (2 * (n - buys))] FROM t
UNION ALL SELECT '/tags/*', 'number', buys, NULL, NULL, NULL, NULL FROM t UNION ALL SELECT '/tags/*', 'string', 2 * (n - buys), NULL, NULL, NULL, NULL FROM t)
"""


@query(STRUCTURE + "SELECT path, type, CAST(seen AS BIGINT) AS seen, CAST(size_min AS BIGINT) AS size_min, CAST(size_max AS BIGINT) AS size_max, round(size_sum / seen, 3) AS size_avg, child_types FROM stats")
def structure_statistics(spark, sf_dir):
    listed = F.transform(F.array_sort(F.map_entries("child_types")), lambda x: F.concat_ws(":", x["key"], x["value"].cast("string")))
    return _event_statistics(spark, sf_dir).select("path", "type", "seen", "size_min", "size_max", "size_avg", listed.alias("child_types"))


@query(
    STRUCTURE
    + """SELECT path, type, 'unknown_field' AS problem, CAST(seen AS BIGINT) AS n FROM stats WHERE path LIKE '/detail%' UNION ALL SELECT path, type, 'unexpected_type', CAST(seen AS BIGINT) FROM stats WHERE path = '/tags/*' AND type = 'number'
UNION ALL SELECT '/props', NULL, 'missing', n - props FROM t WHERE n > props UNION ALL SELECT '/tags/0', NULL, 'missing', n FROM t WHERE false UNION ALL SELECT '/origin', NULL, 'missing', n FROM t"""
)
def structure_gate(spark, sf_dir):
    contract = [("", ["object"], True), ("/kind", ["string"], True), ("/props", ["object"], True), ("/props/k", ["number"], True), ("/tags", ["array"], True), ("/tags/*", ["string"], False), ("/origin", ["string"], True)]
    return structure.structure_gate(_event_statistics(spark, sf_dir), contract)


@query(
    """WITH i AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS a, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value) AS BIGINT) * 60 AS b FROM events), m AS (SELECT event_type, a AS moment, 1 AS c FROM i WHERE a < b UNION ALL SELECT event_type, b, -1 FROM i WHERE a < b),
g AS (SELECT event_type, moment, sum(c) AS c FROM m GROUP BY ALL) SELECT event_type, moment AS "at", CAST(sum(c) OVER (PARTITION BY event_type ORDER BY moment) AS BIGINT) AS running FROM g"""
)
def interval_concurrency(spark, sf_dir):
    """Events as intervals of as many minutes as their value: how many of a type run at each moment."""
    start = F.unix_timestamp("ts")
    e = table(spark, sf_dir, "events").select("event_type", start.alias("a"), (start + F.floor("value") * 60).alias("b"))
    return sequences.concurrency(e, ["event_type"], "a", "b", block=86_400)


# --- canonical concepts --------------------------------------------------------------------------
#: Texts are one concept when they are equal in NFC, trimmed, with white space collapsed and letter case folded away.
CANONICAL = UNITS + r""", canon AS (SELECT *, lower(regexp_replace(nfc_normalize(unit_text), '\s+', ' ', 'g')) AS c FROM units)
"""


def _canonical():
    return text.canonicaliser(text.CanonicalRules(casefold=False))


def _folded(c):
    return F.lower(_canonical()(c))


@query(CANONICAL + "SELECT DISTINCT sha256(c) AS concept_id, c AS unit_text FROM canon WHERE c <> ''")
def canonical_concepts(spark, sf_dir):
    return anchors.concept_declarations(_units(spark, sf_dir).withColumn("decision", F.lit(None).cast("string")), _folded)


@query(CANONICAL + "SELECT sha256(concat_ws('|', sha256(c), asset_id, path, segment_index, char_start, char_end)) AS instance_id, sha256(c) AS concept_id, unit_id FROM canon WHERE c <> ''")
def canonical_instances(spark, sf_dir):
    found = anchors.instance_declarations(_units(spark, sf_dir), canonical=_folded)
    return found.select("instance_id", "concept_id", units.unit_id().alias("unit_id"))


# --- messages of the canonical form --------------------------------------------------------------
MESSAGES = """WITH m AS (SELECT CAST(conv_id AS VARCHAR) AS c, conv_id || ':' || turn AS node, CASE WHEN role = 'system' THEN 'system' ELSE conv_id || ':' || turn END AS id, role, turn, text,
CASE WHEN length(text) > 120 THEN 1 ELSE 0 END AS place, CASE WHEN text LIKE '%.' THEN 'iso8601' ELSE 'date' END AS raw, CASE WHEN length(text) < 80 THEN '2024-05-0' || (turn % 9 + 1) || 'T10:00:00' ELSE '2024-05-0' || (turn % 9 + 1) || 'T10:00:00Z' END AS utc FROM conversations),
e AS (SELECT *, list_filter([CASE WHEN role = 'assistant' AND turn > 2 THEN 'role' END, CASE WHEN turn = 0 THEN 'content_type' END, CASE WHEN place = 1 THEN 'part.part_index' END, CASE WHEN raw = 'date' THEN 'event_time.raw_type' END, CASE WHEN utc NOT LIKE '%Z' THEN 'event_time.normalized_utc' END, CASE WHEN turn = 1 THEN 'message.source_sha256' END], lambda x: x IS NOT NULL) AS errors FROM m)
"""


def _messages(spark, sf_dir):
    """Turns as canonical messages with faults: system turns share an id, later assistants have an unknown role, long texts a wrong part index, short ones a time without zone."""
    c = table(spark, sf_dir, "conversations")
    node = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    sha = F.sha2("text", 256)
    ref = lambda digest: F.struct(F.lit("f").alias("source_file_id"), F.lit("").alias("source_path"), F.lit(None).cast("long").alias("source_index"), F.lit(None).cast("string").alias("source_id"), digest.alias("source_value_sha256"), F.lit("direct").alias("mapping_method"), F.lit("lossless").alias("loss_status"))
    part = F.struct(F.lit("p0").alias("part_id"), F.when(F.length("text") > 120, 1).otherwise(0).cast("long").alias("part_index"), F.lit("text").alias("part_type"), F.col("text"), ref(sha).alias("source_ref"))
    day = F.concat(F.lit("2024-05-0"), (F.col("turn") % 9 + 1).cast("string"), F.lit("T10:00:00"))
    utc = F.when(F.length("text") < 80, day).otherwise(F.concat(day, F.lit("Z")))
    event = F.struct(F.lit("created").alias("event_kind"), F.when(F.col("text").endswith("."), "iso8601").otherwise("date").alias("raw_type"), utc.alias("normalized_utc"), F.lit("verified").alias("semantic_status"), ref(sha).alias("source_ref"))
    return c.select(
        F.col("conv_id").cast("string").alias("conversation_id"),
        node.alias("node_id"),
        F.when(F.col("role") == "system", "system").otherwise(node).alias("message_id"),
        F.when((F.col("role") == "assistant") & (F.col("turn") > 2), "bot").otherwise(F.col("role")).alias("role"),
        F.col("role").alias("source_role"),
        F.when(F.col("turn") > 0, "text").otherwise("").alias("content_type"),
        F.array(part).alias("parts"),
        F.array(event).alias("event_times"),
        ref(F.when(F.col("turn") == 1, F.upper(sha)).otherwise(sha)).alias("source_ref"),
    )


@query(MESSAGES + "SELECT c AS conversation_id, node AS node_id, id AS message_id, unnest(errors) AS error FROM e UNION ALL SELECT c, node, id, 'repeated_message_id' FROM e WHERE id IN (SELECT id FROM e GROUP BY 1 HAVING count(*) > 1)")
def message_violations(spark, sf_dir):
    return contracts.message_violations(_messages(spark, sf_dir))


@query("SELECT count(DISTINCT conv_id) AS conversations, count(*) AS messages, count(*) AS content_parts, count(*) AS event_times FROM conversations")
def message_counts(spark, sf_dir):
    return contracts.message_counts(_messages(spark, sf_dir))
