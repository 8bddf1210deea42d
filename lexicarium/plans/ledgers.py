"""Registered queries of contracts and ledgers, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexicarium.operators import contracts
from lexicarium.plans.queries import query, table
from lexicarium.plans.reports import _event_nodes
from lexicarium.sources import files


@query(
    """WITH r AS (SELECT CAST(conv_id AS VARCHAR) AS c, turn AS t FROM conversations), n AS (SELECT c, t, count(*) AS k FROM r GROUP BY ALL),
g AS (SELECT c, sum(k) AS rows, count(*) AS d, min(t) AS low, max(t) AS high FROM n GROUP BY c)
SELECT c AS conversation_id, c || ':' || t AS node_id, 'repeated_node' AS error FROM n WHERE k > 1
UNION ALL SELECT c, c || ':' || t, 'repeated_child' FROM n WHERE k > 1
UNION ALL SELECT c, c || ':' || t, 'parent_missing' FROM n WHERE t > 0 AND NOT EXISTS (SELECT 1 FROM n o WHERE o.c = n.c AND o.t = n.t - 1)
UNION ALL SELECT c, c || ':' || t, 'child_missing' FROM n WHERE NOT EXISTS (SELECT 1 FROM n o WHERE o.c = n.c AND o.t = n.t + 1)
UNION ALL SELECT c, NULL, 'node_order' FROM g WHERE rows <> d OR low <> 0 OR high <> rows - 1
UNION ALL SELECT c, NULL, 'no_root' FROM g WHERE low > 0"""
)
def node_violations(spark, sf_dir):
    """Each turn names the turn before as its parent and the turn after as its child: the last turn's child is always missing."""
    c = table(spark, sf_dir, "conversations")
    at = lambda step: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") + step).cast("string"))
    return contracts.node_violations(c.select(F.col("conv_id").cast("string").alias("conversation_id"), at(0).alias("node_id"), F.col("turn").alias("node_order"), F.when(F.col("turn") > 0, at(-1)).alias("parent_id"), F.array(at(1)).alias("child_ids")))


@query("SELECT event_id AS annotation_id, list_filter([CASE WHEN coalesce(json_extract_string(props, '$.k'), '') = '' THEN 'missing_path' END, CASE WHEN event_type NOT IN ('view', 'click') THEN 'resolution_status' END, CASE WHEN event_id % 7 <= user_id % 7 THEN 'span' END, CASE WHEN event_id % 12 > 10 THEN 'confidence' END], lambda x: x IS NOT NULL) AS errors FROM events WHERE coalesce(json_extract_string(props, '$.k'), '') = '' OR event_type NOT IN ('view', 'click') OR event_id % 7 <= user_id % 7 OR event_id % 12 > 10")
def annotation_errors(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("annotation_id"), F.get_json_object("props", "$.k").alias("path"), F.col("event_type").alias("resolution_status"), (F.col("user_id") % 7).alias("span_start"), (F.col("event_id") % 7).alias("span_end"), ((F.col("event_id") % 12) / 10).alias("confidence"))
    return contracts.annotation_errors(e, ["path"], ["view", "click"])


def _values(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("asset_id"), F.concat(F.lit("/"), "source", F.lit("/"), "lang").alias("path"), F.lit(0).alias("value_index"), F.sha1("text").alias("source_value_sha1"))


@query("WITH v AS (SELECT CAST(doc_id AS VARCHAR) AS a, '/' || source || '/' || lang AS p, sha1(text) AS h FROM documents), k AS (SELECT DISTINCT a, p, h FROM v WHERE a <> '' AND p <> '' AND h <> '') SELECT count(*) AS coordinates, count(DISTINCT a) AS assets, count(DISTINCT p) AS paths, (SELECT count(*) FROM v WHERE coalesce(a, '') = '' OR coalesce(p, '') = '' OR coalesce(h, '') = '') AS invalid FROM k")
def access_manifest(spark, sf_dir):
    return contracts.access_manifest(_values(spark, sf_dir))


@query("SELECT CAST(d.doc_id AS VARCHAR) AS asset_id, '/' || source || '/' || lang AS path, 0 AS value_index, sha1(text) AS source_value_sha1 FROM documents d WHERE source || lang || sha1(text) IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels)")
def authorized_values(spark, sf_dir):
    """The labelled documents' coordinates against all documents."""
    v = _values(spark, sf_dir)
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("asset_id")).distinct()
    return contracts.authorized(v, contracts.source_coordinates(v.join(labelled, "asset_id", "left_semi"))).select(*contracts.SOURCE_COORDINATE)


@query("WITH s AS (SELECT vec_id AS k, count(*) AS n, min(label) AS lo, max(label) AS hi FROM embeddings GROUP BY 1), c AS (SELECT doc_id AS k, min(lang) AS known FROM documents GROUP BY 1), b AS (SELECT s.k AS sk, c.k AS ck, n, lo, hi, known FROM s FULL JOIN c ON s.k = c.k), p AS (SELECT unnest(list_filter([CASE WHEN n > 1 THEN 'duplicate_key' END, CASE WHEN ck IS NULL THEN 'canonical_missing' END, CASE WHEN sk IS NULL THEN 'side_missing' END, CASE WHEN sk IS NOT NULL AND ck IS NOT NULL AND (CAST(lo AS VARCHAR) IS DISTINCT FROM known OR CAST(hi AS VARCHAR) IS DISTINCT FROM known) THEN 'payload_mismatch' END], lambda x: x IS NOT NULL)) AS problem FROM b) SELECT problem, count(*) AS n FROM p GROUP BY 1")
def side_table_problems(spark, sf_dir):
    side = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("k"), F.col("label").cast("string").alias("v"))
    return contracts.side_table_problems(side, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), F.col("lang").alias("v")), "k", "v")


@query("SELECT unnest(['conversations', 'parts']) AS measure, count(*) AS input, count(*) AS output, true AS reconciled FROM conversations")
def export_conservation(spark, sf_dir):
    """Every turn as an export of its own, read back as canonical nodes: none is lost."""
    c = table(spark, sf_dir, "conversations")
    name = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    message = F.struct(F.lit("m").alias("uuid"), F.col("role").alias("sender"), F.col("text"), F.lit(None).cast("string").alias("created_at"))
    raw = c.select(F.to_json(F.struct(name.alias("uuid"), F.lit("").alias("name"), F.array(message).alias("chat_messages"))).alias("json"))
    nodes = files.canonical_nodes(raw)
    return contracts.conservation(conversations=(raw, nodes.select("conversation_id").distinct()), parts=(raw, nodes))


@query("SELECT '/props' AS path, count(*) AS n FROM events UNION ALL SELECT '/props/k', count(*) FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def forbidden_keys(spark, sf_dir):
    return contracts.forbidden_keys(_event_nodes(spark, sf_dir), ["K", "props", "decision"])


@query("SELECT user_id AS run_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS events, CASE WHEN arg_max(event_type, {'a': ts, 'b': event_id}) IN ('purchase', 'error') THEN arg_max(event_type, {'a': ts, 'b': event_id}) ELSE 'running' END AS state FROM events GROUP BY user_id")
def run_states(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("at"), "event_id", F.col("event_type").alias("status"))
    return contracts.run_states(log, ["at", "event_id"], ["purchase", "error"])


@query("WITH i AS (SELECT l_orderkey AS k, count(*) AS n, arg_max(l_linestatus, {'a': l_linenumber, 'b': l_linestatus}) AS s FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) SELECT o_orderkey AS delivery_id, o_orderstatus AS status, coalesce(n, 0) AS index_events, coalesce(s, 'not_requested') AS index_status FROM orders LEFT JOIN i ON o_orderkey = k")
def delivery_status(spark, sf_dir):
    events = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("delivery_id"), F.col("l_linenumber").alias("event_id"), F.col("l_linestatus").alias("status"))
    return contracts.delivery_status(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("delivery_id"), F.col("o_orderstatus").alias("status")), events)


@query("SELECT c_custkey AS task_id, max(o_orderkey) AS head, count(o_orderkey) AS revisions FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def resumed_tasks(spark, sf_dir):
    return contracts.resumed(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("task_id")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("task_id"), F.col("o_orderkey").alias("revision")))


@query("WITH l AS (SELECT page_id, sha256(html) AS h, string_split(html, chr(10)) AS ls FROM pages), x AS (SELECT page_id, h, unnest(ls) AS line, unnest(range(0, len(ls))) AS i FROM l) SELECT page_id, CAST(i AS INTEGER) AS unit_index, sha256(h || '|lines|1|open|' || i) AS unit_id FROM x WHERE trim(line) <> ''")
def intake_units(spark, sf_dir):
    return contracts.intake_units(table(spark, sf_dir, "pages"), "page_id", "html", "lines", "1", "open")


@query("SELECT conv_id, turn, CAST(floor(coalesce(sum(strlen(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 500) AS BIGINT) AS batch FROM conversations")
def byte_batches(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return files.byte_batches(c, "conv_id", "turn", F.octet_length("text"), 500).select("conv_id", "turn", "batch")


@query("SELECT conv_id, sha256('[' || string_agg('{\"turn\":' || turn || ',\"role\":\"' || role || '\"}', ',' ORDER BY turn) || ']') AS digest FROM conversations GROUP BY conv_id")
def array_digests(spark, sf_dir):
    return files.array_digest(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.to_json(F.struct("turn", "role")))
