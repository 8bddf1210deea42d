"""More registered queries: graphs, audits, attachments, retrieval, structure and temporal reports, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexicarium.functions import temporal, text
from lexicarium.operators import anchors, audits, graphs, retrieval, structure, units
from lexicarium.operators.tables import cut
from lexicarium.plans.queries import ADJACENCY, ANNOTATIONS, CONCEPTS, ENDS, NODES, UNITS, _annotations, _units, query, spread, table
from lexicarium.sources import files


# --- graphs ----------------------------------------------------------------------------------
def _pages_graph(spark, sf_dir):
    return graphs.adjacency_edges(_units(spark, sf_dir))


@query(UNITS + ADJACENCY + ENDS + "SELECT (SELECT count(*) FROM dg) AS node_count, (SELECT min(degree) FROM dg) AS min_degree, (SELECT max(degree) FROM dg) AS max_degree, (SELECT round(avg(degree), 6) FROM dg) AS mean_degree, count(*) AS edge_count, min(weight) AS min_weight, max(weight) AS max_weight, round(avg(weight), 6) AS mean_weight, round(2 * count(*) / CAST((SELECT count(*) * (count(*) - 1) FROM dg) AS DOUBLE), 12) AS density FROM edges")
def graph_statistics_undirected(spark, sf_dir):
    e = _pages_graph(spark, sf_dir)
    return graphs.graph_statistics(graphs.nodes_of(e), e, directed=False)


@query(UNITS + ADJACENCY + "SELECT least(src, dst) AS src, greatest(src, dst) AS dst, CAST(weight AS DOUBLE) AS weight FROM edges")
def normalised_edges(spark, sf_dir):
    return graphs.normalised_edges(_pages_graph(spark, sf_dir), directed=False)


@query(UNITS + ADJACENCY + "SELECT e.* FROM edges e WHERE src IN (SELECT unit_text FROM units GROUP BY 1 HAVING count(*) >= 3) AND dst IN (SELECT unit_text FROM units GROUP BY 1 HAVING count(*) >= 3)")
def registered_edges(spark, sf_dir):
    u = _units(spark, sf_dir)
    return graphs.edges_between(graphs.adjacency_edges(u), units.frequent_units(u, least=3).select(F.col("unit_text").alias("node")))


@query(UNITS + ADJACENCY + "SELECT * FROM edges WHERE weight >= 2 ORDER BY weight DESC, src, dst LIMIT 50")
def heaviest_edges(spark, sf_dir):
    return graphs.prune_edges(_pages_graph(spark, sf_dir), least=2, per_node=1_000_000, most=50)


@query("SELECT CAST(0 AS BIGINT) AS n, 'container_too_large' AS reason WHERE false UNION ALL " + "SELECT n, reason FROM (" + UNITS + "SELECT 'container_too_large' AS reason, count(*) AS n FROM (SELECT count(*) AS c FROM units GROUP BY asset_id, path, value_index, segment_index) WHERE c > 500)")
def skipped_containers(spark, sf_dir):
    return graphs.skipped_containers(_units(spark, sf_dir))


@query()
def unit_components(spark, sf_dir):
    """Components of the units' whole adjacency graph: count and largest (no SQL: a recursion over all edges; a test holds it to a plain union-find)."""
    u = _units(spark, sf_dir).withColumn("unit_text", graphs.short_key("unit_text"))
    return graphs.size_summary(graphs.component_sizes(graphs.adjacency_edges(u)))


@query(NODES + "SELECT count(*) AS nodes, count(*) FILTER (parent_id IS NULL) AS roots, (SELECT count(*) FROM (SELECT asset_id FROM nodes GROUP BY 1)) AS leaves, max(depth) AS max_depth, CAST(0 AS BIGINT) AS unreached, CAST(0 AS BIGINT) AS dangling_parents, false AS has_cycle FROM nodes")
def tree_statistics(spark, sf_dir):
    return graphs.tree_statistics(graphs.tree_depths(graphs.conversation_nodes(table(spark, sf_dir, "conversations"))))


@query("WITH e AS (SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child, CAST(c AS DOUBLE) AS weight FROM nation JOIN (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) ON n_nationkey = c_nationkey), k AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY weight DESC, child) AS r FROM e) SELECT parent, child, weight FROM k WHERE r <= 3")
def top_children(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    e = table(spark, sf_dir, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey")).select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("child"), "weight")
    return graphs.hierarchy_edges(e.unionByName(e.withColumn("weight", F.col("weight") - 1)), per_parent=3)


@query("WITH s AS (SELECT CAST(ts AS DATE) AS taken, count(DISTINCT user_id) AS node_count, count(*) AS edge_count FROM events GROUP BY 1), d AS (SELECT *, edge_count / (node_count * (node_count - 1.0)) AS density FROM s WHERE node_count > 1) SELECT count(*) AS snapshots, CAST(min(taken) AS VARCHAR) AS first_taken, CAST(max(taken) AS VARCHAR) AS last_taken, min(node_count) AS node_count_min, round(avg(node_count), 6) AS node_count_mean, max(node_count) AS node_count_max, min(edge_count) AS edge_count_min, round(avg(edge_count), 6) AS edge_count_mean, max(edge_count) AS edge_count_max, round(min(density), 9) AS density_min, round(avg(density), 6) AS density_mean, round(max(density), 9) AS density_max FROM d")
def snapshot_trend(spark, sf_dir):
    s = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("taken")).agg(F.count_distinct("user_id").alias("node_count"), F.count(F.lit(1)).alias("edge_count")).where("node_count > 1")
    t = graphs.snapshot_trend(s.withColumn("density", F.col("edge_count") / (F.col("node_count") * (F.col("node_count") - 1))))
    return t.withColumn("first_taken", F.col("first_taken").cast("string")).withColumn("last_taken", F.col("last_taken").cast("string")).withColumn("density_min", F.round("density_min", 9)).withColumn("density_max", F.round("density_max", 9))


@query("WITH r AS (SELECT CASE event_type WHEN 'click' THEN 'follows' WHEN 'view' THEN 'based_on' ELSE event_type END AS kind, user_id AS src, event_id % 50 AS dst FROM events) SELECT kind, src, dst, CASE WHEN kind NOT IN ('follows', 'based_on') THEN 'unknown_kind' WHEN src = dst THEN 'self_reference' WHEN src NOT IN (SELECT c_custkey FROM customer) OR dst NOT IN (SELECT c_custkey FROM customer) THEN 'unknown_end' END AS problem FROM r")
def relation_problems(spark, sf_dir):
    kind = F.when(F.col("event_type") == "click", "follows").when(F.col("event_type") == "view", "based_on").otherwise(F.col("event_type"))
    r = table(spark, sf_dir, "events").select(kind.alias("kind"), F.col("user_id").alias("src"), (F.col("event_id") % 50).alias("dst"))
    return graphs.relation_problems(r, table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("node")))


# --- audits ----------------------------------------------------------------------------------
SEVEN = "asset_id, path, value_index, segment_index, sentence_index, char_start, char_end"


@query(UNITS + "SELECT count(*) AS checked, count(*) AS found, CAST(0 AS BIGINT) AS missing FROM units")
def anchor_verification(spark, sf_dir):
    u = _units(spark, sf_dir)
    return audits.anchor_verification(anchors.instance_declarations(u), u)


@query(UNITS + f", f AS (SELECT {SEVEN} FROM units WHERE unit_text IN (SELECT unit_text FROM units GROUP BY 1 HAVING count(*) >= 2)) SELECT {SEVEN} FROM units EXCEPT SELECT * FROM f")
def uncovered_units(spark, sf_dir):
    u = _units(spark, sf_dir)
    often = u.join(units.frequent_units(u).select("unit_text"), "unit_text", "left_semi")
    return audits.unmatched(u, often).select(*units.COORDINATE)


@query(UNITS + f"SELECT count(*) AS selected, count(*) AS matched, true AS conserved FROM (SELECT DISTINCT {SEVEN} FROM units WHERE path = '/src0/en')")
def conserved_selection(spark, sf_dir):
    u = _units(spark, sf_dir)
    return audits.conserved(u.where("path = '/src0/en'"), u)


@query(UNITS + CONCEPTS + ", d AS (SELECT CAST(unnest(['instance_without_concept', 'attribute_without_object', 'repeated_concept', 'repeated_instance', 'repeated_attribute', 'attribute_conflict']) AS VARCHAR) AS check_name) SELECT check_name, CASE check_name WHEN 'instance_without_concept' THEN (SELECT count(*) FROM instances JOIN concepts USING (concept_id) WHERE length(unit_text) < 4) WHEN 'repeated_instance' THEN (SELECT count(*) FROM (SELECT instance_id FROM instances GROUP BY 1 HAVING count(*) > 1)) WHEN 'attribute_without_object' THEN (SELECT count(*) FROM concepts WHERE length(unit_text) < 4) ELSE 0 END AS violations FROM d")
def payload_topology(spark, sf_dir):
    """The instances and attributes of all concepts against the longer ones: short concepts are missing in the payload."""
    u, _ = cut(_units(spark, sf_dir).drop("unit_id"))  # split once
    concepts = anchors.concept_declarations(u.select("unit_text", F.lit(None).cast("string").alias("decision")))
    every, _ = cut(concepts.select("concept_id", F.length("unit_text").alias("size")))  # several checks read it
    a = anchors.attribute_declarations(every.withColumnRenamed("concept_id", "object_id"), ["size"])
    return audits.topology(every.where("size >= 4"), anchors.instance_declarations(u), a)


@query("SELECT 'documents' AS table_name, count(*) AS total, count(*) FILTER (source = 'src0') AS current FROM documents UNION ALL SELECT 'labelled', count(*), count(*) FILTER (source = 'src0') FROM documents JOIN (SELECT DISTINCT doc_id FROM labels) USING (doc_id)")
def run_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("run_id"))
    return audits.run_counts("src0", documents=d, labelled=d.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi"))


@query("WITH a AS (SELECT source, lang, min(doc_id) AS first_id, count(DISTINCT toxic) AS n, min(toxic) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY ALL) SELECT d.doc_id, CASE WHEN coalesce(n, 0) = 0 THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'attached' END AS attach_status, CASE WHEN n = 1 THEN toxic END AS toxic FROM documents d LEFT JOIN a ON d.source IS NOT DISTINCT FROM a.source AND d.lang IS NOT DISTINCT FROM a.lang")
def attached_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    marks = d.join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id").select("source", "lang", "toxic")
    return audits.attached(d, marks, ["source", "lang"], "toxic").select("doc_id", "attach_status", "toxic")


@query("SELECT count(*) AS n FROM (SELECT doc_id, text FROM documents) WHERE false")
def replay_differences(spark, sf_dir):
    """A replay of the units against themselves in another order: no record differs, and the digests are equal."""
    u = _units(spark, sf_dir)
    return audits.record_differences(u, u.repartition("unit_id", "char_start"), ["unit_id"]).agg(F.count(F.lit(1)).alias("n"))


LOG = "WITH log AS (SELECT 'doc' AS object_type, label AS object_id, CAST(vec_id AS VARCHAR) AS signature, vec_id AS seq, CASE WHEN vec_id % 3 = 0 THEN 'replaced' ELSE 'active' END AS state FROM embeddings)\n"


def _log(spark, sf_dir):
    v = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(F.lit("doc").alias("object_type"), F.col("label").alias("object_id"), v.cast("string").alias("signature"), v.alias("seq"), F.when(v % 3 == 0, "replaced").otherwise("active").alias("state"))


@query(LOG + "SELECT object_type, object_id, signature FROM (SELECT *, row_number() OVER (PARTITION BY object_type, object_id ORDER BY seq DESC) AS r FROM log) WHERE r = 1 AND state = 'active'")
def active_index(spark, sf_dir):
    return audits.active_index(_log(spark, sf_dir))


@query(LOG + "SELECT object_type, object_id, count(DISTINCT signature) AS n FROM log WHERE state = 'active' GROUP BY ALL HAVING count(DISTINCT signature) > 1")
def several_active(spark, sf_dir):
    return audits.several_active(_log(spark, sf_dir))


@query("SELECT vec_id AS object_id, list_filter([CASE WHEN d.doc_id IS NULL THEN 'source_missing' END, CASE WHEN d.n_chars <> label THEN 'source_changed' END, CASE WHEN len(embedding) <> 64 THEN 'dimension' END], lambda x: x IS NOT NULL) AS errors FROM embeddings e LEFT JOIN documents d ON e.vec_id = d.doc_id WHERE d.doc_id IS NULL OR d.n_chars <> label OR len(embedding) <> 64")
def embedding_contract(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("object_id"), "embedding", F.col("label").cast("string").alias("source_hash"))
    return audits.contract_errors(e, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("object_id"), F.col("n_chars").cast("string").alias("source_hash")), 64)


@query("SELECT CASE WHEN e.vec_id IS NULL THEN 'index_only' WHEN d.doc_id IS NULL THEN 'store_only' ELSE 'both' END AS side, count(*) AS n FROM documents d FULL JOIN embeddings e ON d.doc_id = e.vec_id GROUP BY 1")
def index_consistency(spark, sf_dir):
    return audits.consistency(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("object_id")), table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("object_id")))


@query("SELECT doc_id, substr(text, 11, 20) AS evidence, length(text) >= 30 AND substr(text, 11, 20) <> '' AS verified FROM documents")
def verified_evidence(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), "text")
    refs = d.select(F.col("source_id").alias("doc_id"), "source_id", F.lit(10).alias("span_start"), F.least(F.lit(30), F.length("text")).alias("span_end"), F.when(F.length("text") >= 30, F.sha2(F.substring("text", 11, 20), 256)).alias("span_hash"))
    refs = refs.withColumn("span_start", F.least("span_start", "span_end"))
    return audits.verified_evidence(refs, d).select("doc_id", "evidence", "verified")


# --- retrieval -------------------------------------------------------------------------------
@query(ANNOTATIONS + "SELECT * FROM n WHERE annotation_type IN ('error') OR body IN ('{\"k\": 1}')")
def failure_annotations(spark, sf_dir):
    return retrieval.failures(_annotations(spark, sf_dir), "annotation_type", ["error"], "body", ['{"k": 1}'])


@query("SELECT event_id, props FROM events WHERE contains(lower(json_extract_string(props, '$.k')), '7')")
def json_search(spark, sf_dir):
    return retrieval.json_search(table(spark, sf_dir, "events").select("event_id", "props"), "props", "$.k", "7")


@query("WITH b AS (SELECT user_id, event_id, (event_id % 5) AS supersedes FROM events), c AS (SELECT supersedes, count(*) AS n FROM b GROUP BY 1 HAVING count(*) > 1) SELECT event_id, b.supersedes, c.n AS branches FROM b LEFT JOIN c ON b.supersedes = c.supersedes")
def conflict_branches(spark, sf_dir):
    b = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 5).alias("supersedes"))
    return retrieval.with_conflicts(b)


@query("WITH r AS (SELECT event_id, user_id AS k, sha256(event_type) AS h, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, sha256(event_type)) AS p, first(sha256(event_type)) OVER (PARTITION BY user_id ORDER BY ts, sha256(event_type)) AS f FROM events), q AS (SELECT c_custkey AS k, sha256('view') AS known FROM customer), j AS (SELECT r.*, coalesce(known, CASE WHEN p > 1 THEN f END) AS held FROM r LEFT JOIN q ON r.k = q.k) SELECT CASE WHEN held IS NULL THEN 'inserted' WHEN held = h THEN 'duplicate' ELSE 'conflict' END AS outcome, count(*) AS n FROM j GROUP BY 1")
def appended_requests(spark, sf_dir):
    r = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("request_id"), "event_type", F.col("ts").alias("request_at"))
    receipts = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("request_id"), F.sha2(F.lit("view"), 256).alias("content_hash"))
    return retrieval.appended(r, receipts, ["request_id"], F.col("event_type")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("WITH s AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), e AS (SELECT user_id, CAST(sum(n) AS BIGINT) AS members, list_sort(list(event_type)) AS slots, list_sort(coalesce(list(event_type) FILTER (n > 1), [])) AS contested, list_filter(['purchase', 'view'], lambda x: NOT list_contains(list(event_type), x)) AS missing FROM s GROUP BY user_id) SELECT *, CASE WHEN len(missing) = 0 THEN 'complete' ELSE 'incomplete' END AS completeness, list_filter([CASE WHEN len(missing) > 0 THEN 'incomplete' END, CASE WHEN len(contested) > 0 THEN 'snapshot_conflict' END, CASE WHEN list_contains(slots, 'error') THEN 'failure_counterexample' END], lambda x: x IS NOT NULL) AS reasons, len(reasons) = 0 AS eligible FROM e")
def episodes(spark, sf_dir):
    return retrieval.episodes(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["view", "purchase"], ["error"])


@query()
def packed_context(spark, sf_dir):
    """No SQL: each choice depends on all before it; a test holds it to a plain loop."""
    return retrieval.packed(table(spark, sf_dir, "conversations"), "text", "conv_id", ["turn"], 1000)


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_events(spark, sf_dir):
    return retrieval.latest_by(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("WITH d AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), p AS (SELECT q.vec_id AS query_id, d.vec_id, round(1 - list_cosine_similarity(q.e, d.e), 6) AS distance, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(1 - list_cosine_similarity(q.e, d.e), 9), d.vec_id) AS rank FROM d q JOIN d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0) SELECT * FROM p WHERE rank <= 10")
def nearest_to_queries(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return retrieval.nearest_to_each(e.where("vec_id % 100 = 0"), e, 10)  # the stated query set, against all rows


# --- structure, temporal, text ---------------------------------------------------------------
EVENT_JSON = "to_json({'kind': event_type, 'props': json(props), 'tags': [event_type, CAST(user_id AS VARCHAR)]})"


def _event_nodes(spark, sf_dir):
    e = spread(table(spark, sf_dir, "events"))
    return structure.json_nodes(e.select("event_id", F.to_json(F.struct(F.col("event_type").alias("kind"), F.from_json("props", "k long").alias("props"), F.array("event_type", F.col("user_id").cast("string")).alias("tags"))).alias("j")), "event_id", "j")


@query("SELECT path, type, CAST(sum(m) AS BIGINT) AS seen, size_min, size_max, size_avg, keys FROM events, (VALUES ('', 'object', 1, 3, 3, 3.0, ['kind', 'props', 'tags']), ('/kind', 'string', 1, NULL, NULL, NULL, NULL), ('/props', 'object', 1, 1, 1, 1.0, ['k']), ('/props/k', 'number', 1, NULL, NULL, NULL, NULL), ('/tags', 'array', 1, 2, 2, 2.0, NULL), ('/tags/*', 'string', 2, NULL, NULL, NULL, NULL)) v(path, type, m, size_min, size_max, size_avg, keys) GROUP BY path, type, size_min, size_max, size_avg, keys")
def json_structure(spark, sf_dir):
    return structure.structure_report(_event_nodes(spark, sf_dir))


@query("SELECT event_id AS id, '/kind' AS path, event_type AS text FROM events UNION ALL SELECT event_id, '/tags/*', unnest([event_type, CAST(user_id AS VARCHAR)]) FROM events")
def string_leaves(spark, sf_dir):
    return structure.string_leaves(_event_nodes(spark, sf_dir), ["/kind", "/tags/*"])


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 10 AS VARCHAR) AS days, CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS months, CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS years FROM orders")
def moved_dates(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", *[temporal.moved(day, F.lit(n), unit).cast("string").alias(f"{unit}s") for n, unit in ((10, "day"), (1, "month"), (-1, "year"))])


@query("SELECT conv_id, turn, '/conversation/mapping/' || conv_id || '-' || turn || '/message/content' AS path, conv_id || '-' || turn AS node, '/message/content' AS suffix FROM conversations")
def path_nodes(spark, sf_dir):
    p = F.concat(F.lit("/conversation/mapping/"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"), F.lit("/message/content"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", p.alias("path"), text.node_of_path(p).alias("node"), text.path_suffix(p).alias("suffix"))


@query("SELECT lower(regexp_extract(url, '([^/]+)$', 1)) AS name, count(*) AS n, count(DISTINCT sha256(html)) AS contents FROM pages GROUP BY 1 HAVING count(*) > 1")
def repeated_names(spark, sf_dir):
    return files.repeated_names(table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.sha2("html", 256).alias("sha256")))


@query("SELECT page_id, CASE WHEN octet_length(encode(html)) > 20000 THEN 'too_large' WHEN lower(ltrim(substr(html, 1, 256))) LIKE '<!doctype html%' OR lower(ltrim(substr(html, 1, 256))) LIKE '<html%' THEN 'text' ELSE 'unsupported' END AS gate FROM pages")
def extraction_gate(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", files.extraction_gate(F.col("html").cast("binary"), F.col("url"), 20_000).alias("gate"))


@query("WITH c AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS index FROM (SELECT DISTINCT conv_id FROM conversations)) SELECT conv_id, index FROM c WHERE index >= 5 AND index < 25")
def conversation_slice(spark, sf_dir):
    return files.conversation_slice(table(spark, sf_dir, "conversations").select("conv_id").distinct(), "conv_id", 5, 20)
