"""Registered queries over the operators, each beside the DuckDB SQL that states the same result (where SQL can)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicarium.functions import temporal, text
from lexicarium.operators import anchors, graphs, profiles, retrieval, units
from lexicarium.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt out to all cores where they are read in fewer partitions than there are cores; larger inputs stay as they are read."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.values_of(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")))


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.split_units(_values(spark, sf_dir))


# The units of documents in SQL, the common start of the statements below.
UNITS = r"""WITH ln AS (SELECT CAST(doc_id AS VARCHAR) AS asset_id, '/' || source || '/' || lang AS path, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lx AS (SELECT asset_id, path, unnest(ls) AS p, unnest(range(0, len(ls))) AS line FROM ln),
lb AS (SELECT *, coalesce(sum(length(p) + 1) OVER (PARTITION BY asset_id, path ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM lx),
sg AS (SELECT asset_id, path, p, base, row_number() OVER (PARTITION BY asset_id, path ORDER BY line) - 1 AS segment_index FROM lb WHERE trim(p) <> ''),
sx AS (SELECT asset_id, path, base, segment_index, regexp_extract_all(p, '[^.?!。！？]*[.?!。！？]+|[^.?!。！？]+$') AS rs FROM sg),
sy AS (SELECT asset_id, path, base, segment_index, unnest(rs) AS raw, unnest(range(0, len(rs))) AS part FROM sx),
sz AS (SELECT *, base + coalesce(sum(length(raw)) OVER (PARTITION BY asset_id, path, segment_index ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(raw) - length(ltrim(raw)) AS char_start FROM sy),
u0 AS (SELECT asset_id, path, 0 AS value_index, segment_index, row_number() OVER (PARTITION BY asset_id, path, segment_index ORDER BY part) - 1 AS sentence_index, CAST(char_start AS BIGINT) AS char_start, CAST(char_start + length(trim(raw)) AS BIGINT) AS char_end, trim(raw) AS unit_text FROM sz WHERE trim(raw) <> ''),
units AS (SELECT *, sha1(concat_ws('|', asset_id, path, value_index, segment_index, sentence_index, char_start, char_end)) AS unit_id FROM u0)
"""


@query(UNITS + "SELECT * FROM units")
def text_units(spark, sf_dir):
    return _units(spark, sf_dir)


@query(
    UNITS
    + """SELECT unit_text, count(*) AS occurrence_count, count(DISTINCT asset_id) AS asset_coverage, list_slice(list_sort(list_distinct(list(path))), 1, 20) AS paths,
round(avg(length(unit_text)), 6) AS avg_char_length, arg_min(unit_id, asset_id || lpad(CAST(segment_index AS VARCHAR), 9, '0') || lpad(CAST(sentence_index AS VARCHAR), 9, '0')) AS example_unit_id FROM units GROUP BY unit_text HAVING count(*) >= 2"""
)
def frequent_units(spark, sf_dir):
    return units.frequent_units(_units(spark, sf_dir))


NOISE = r""", noise AS (SELECT unit_text, list_filter([CASE WHEN unit_text = '' THEN 'empty_unit_text' END, CASE WHEN length(unit_text) < 2 THEN 'below_min_length' END, CASE WHEN regexp_matches(unit_text, '^\p{Nd}+$') THEN 'numeric_only' END,
CASE WHEN regexp_matches(unit_text, '^[.,;:!?，。；：？！]+$') THEN 'pure_punctuation' END, CASE WHEN regexp_matches(unit_text, '^[-_=+*/\\|<>~`^#@]+$') THEN 'symbol_only' END,
CASE WHEN regexp_matches(unit_text, '^[-_]{2,}$') THEN 'repeated_symbols' END, CASE WHEN regexp_matches(unit_text, '^\*{2,}$') THEN 'repeated_symbols' END, CASE WHEN regexp_matches(unit_text, '^\p{Nd}+$') THEN 'numeric_only' END], lambda x: x IS NOT NULL) AS reasons,
CASE WHEN len(reasons) > 0 THEN 'DROP' ELSE 'KEEP' END AS verdict FROM (SELECT DISTINCT unit_text FROM units))
"""


@query(UNITS + NOISE + "SELECT * FROM noise")
def noise_units(spark, sf_dir):
    return units.noise_verdict(_units(spark, sf_dir))


@query(UNITS + NOISE + "SELECT verdict, reason, count(*) AS n FROM (SELECT verdict, unnest(CASE WHEN len(reasons) > 0 THEN list_distinct(reasons) ELSE [NULL] END) AS reason FROM noise) GROUP BY ALL")
def noise_reason_counts(spark, sf_dir):
    return units.noise_reason_counts(units.noise_verdict(_units(spark, sf_dir)))


@query(UNITS + "SELECT unit_id, length(unit_text) AS char_len, len(regexp_extract_all(unit_text, '[.,;:!?。！？]')) AS punct_count FROM units")
def unit_marks(spark, sf_dir):
    return units.unit_marks(_units(spark, sf_dir))


PROFILE = """, pos AS (SELECT *, max(sentence_index) OVER (PARTITION BY asset_id, path, segment_index) AS last FROM units),
bk AS (SELECT *, CASE WHEN last > 0 THEN CAST(sentence_index AS DOUBLE) / last ELSE 0 END AS r FROM pos),
bp AS (SELECT unit_text, path, count(*) AS n, count(DISTINCT asset_id || ':' || segment_index) AS segments, count(*) FILTER (r <= 0.33) AS early, count(*) FILTER (r > 0.33 AND r < 0.67) AS middle, count(*) FILTER (r >= 0.67) AS late FROM bk GROUP BY unit_text, path),
profile AS (SELECT unit_text, CAST(sum(n) AS BIGINT) AS occurrence_count, CAST(sum(segments) AS BIGINT) AS segment_coverage, count(*) AS path_diversity, arg_max(path, lpad(CAST(n AS VARCHAR), 12, '0') || path) AS dominant_path, round(max(n) / sum(n), 6) AS dominant_path_ratio,
CASE WHEN count(*) >= 3 AND sum(segments) >= 5 THEN 'stable' WHEN count(*) = 1 AND sum(segments) <= 2 THEN 'incidental' ELSE 'diffuse' END AS structural_role, CAST(sum(early) AS BIGINT) AS early, CAST(sum(middle) AS BIGINT) AS middle, CAST(sum(late) AS BIGINT) AS late,
max(n) / sum(n) >= 0.8 AS high_path_concentration, sum(segments) = 1 AS single_segment_bias FROM bp GROUP BY unit_text)
"""


@query(UNITS + PROFILE + "SELECT * FROM profile")
def structure_profile(spark, sf_dir):
    return units.structure_profile(_units(spark, sf_dir))


BOUNDARY = """, ba AS (SELECT unit_text, count(*) AS n, var_pop(CAST(length(unit_text) AS DOUBLE)) AS lv, min(length(unit_text)) AS lo, max(length(unit_text)) AS hi FROM units GROUP BY unit_text),
bs AS (SELECT unit_text, CASE WHEN count(*) > 1 THEN 1 - max(n) / sum(n) ELSE 0 END AS seg, count(*) AS segs FROM (SELECT unit_text, segment_index, count(*) AS n FROM units GROUP BY ALL) GROUP BY unit_text),
bt AS (SELECT unit_text, CASE WHEN count(*) > 1 THEN 1 - max(n) / sum(n) ELSE 0 END AS sen, count(*) AS sens FROM (SELECT unit_text, segment_index, sentence_index, count(*) AS n FROM units GROUP BY ALL) GROUP BY unit_text),
bi AS (SELECT *, list_filter([CASE WHEN lv > 3.5 THEN 'length_variance_severe' WHEN lv > 1.5 THEN 'length_variance_high' END, CASE WHEN seg > 0.5 THEN 'segment_crossing_severe' WHEN seg > 0.2 THEN 'segment_crossing_frequent' END, CASE WHEN sen > 0.6 THEN 'sentence_crossing_severe' WHEN sen > 0.3 THEN 'sentence_crossing_frequent' END], lambda x: x IS NOT NULL) AS issues FROM ba JOIN bs USING (unit_text) JOIN bt USING (unit_text)),
boundary AS (SELECT unit_text, n AS occurrence_count, CASE WHEN n < 3 OR len(issues) = 0 THEN 'OK' WHEN list_has_any(issues, ['length_variance_severe', 'segment_crossing_severe', 'sentence_crossing_severe']) THEN 'ANOMALOUS' ELSE 'UNSTABLE' END AS boundary_status, CASE WHEN n < 3 THEN ['insufficient_sample'] ELSE issues END AS boundary_issues,
CASE WHEN n >= 3 THEN round(lv, 6) END AS length_variance, CASE WHEN n >= 3 THEN lo END AS length_min, CASE WHEN n >= 3 THEN hi END AS length_max, CASE WHEN n >= 3 THEN round(seg, 6) END AS segment_cross_ratio, CASE WHEN n >= 3 THEN round(sen, 6) END AS sentence_cross_ratio, CASE WHEN n >= 3 THEN segs END AS segments_observed, CASE WHEN n >= 3 THEN sens END AS sentences_observed FROM bi)
"""
#: Boundary rows of kept texts only meet the decision, as in the chain of stages.
DECIDED = """, decided AS (SELECT p.unit_text, CASE WHEN coalesce(lower(b.boundary_status), '') <> 'ok' THEN 'DELAY' WHEN structural_role = 'stable' THEN 'ALLOW' WHEN structural_role = 'diffuse' THEN 'DELAY' WHEN structural_role = 'incidental' THEN 'FREEZE' ELSE 'ALLOW' END AS decision,
CASE WHEN decision = 'ALLOW' THEN 1.0 WHEN decision = 'FREEZE' THEN 0.75 ELSE 0.5 END AS audit_confidence, CASE WHEN b.unit_text IS NULL THEN 'miss' ELSE 'hit' END AS join_status, b.boundary_status, CAST(NULL AS VARCHAR) AS noise_risk, structural_role
FROM profile p LEFT JOIN (SELECT * FROM boundary WHERE unit_text IN (SELECT unit_text FROM noise WHERE verdict = 'KEEP')) b ON p.unit_text = b.unit_text)
"""


@query(UNITS + BOUNDARY + "SELECT * FROM boundary")
def boundary_profile(spark, sf_dir):
    return units.boundary_profile(_units(spark, sf_dir))


@query(UNITS + PROFILE + BOUNDARY + NOISE + DECIDED + "SELECT * FROM decided")
def prominence(spark, sf_dir):
    return units.value_decisions(_values(spark, sf_dir))


@query(UNITS + PROFILE + BOUNDARY + NOISE + DECIDED + "SELECT sha1(t) AS unit_id, 'SU_v0002_' || substr(sha256(t), 1, 12) AS registry_id, t AS unit_text FROM (SELECT DISTINCT trim(unit_text) AS t FROM decided WHERE decision = 'ALLOW') WHERE t <> ''")
def structural_register(spark, sf_dir):
    return units.register(units.value_decisions(_values(spark, sf_dir)))


@query(UNITS + "SELECT * FROM units WHERE path IN ('/src0/en', '/src1/de')")
def selected_units(spark, sf_dir):
    return units.selected_units(_units(spark, sf_dir), ["/src0/en", "/src1/de"])


@query(UNITS + "SELECT unit_id, CASE WHEN unit_text = '' THEN 'empty_text' WHEN char_start < 0 OR char_end < char_start THEN 'invalid_span' END AS reason FROM units")
def record_reasons(spark, sf_dir):
    return units.record_reasons(_units(spark, sf_dir))


@query(
    UNITS
    + """, l AS (SELECT length(unit_text) AS n, row_number() OVER (ORDER BY length(unit_text)) - 1 AS r, count(*) OVER () AS c FROM units), rp AS (SELECT unit_text, count(*) AS n FROM units GROUP BY unit_text)
SELECT count(*) AS unit_count, count(*) FILTER (n < 3) AS near_empty, round(avg(n), 6) AS mean_length, median(n) AS median_length, min(n) FILTER (r >= least(floor(c * 0.9), c - 1)) AS p90, min(n) FILTER (r >= least(floor(c * 0.99), c - 1)) AS p99, max(n) AS max_length,
(SELECT round(sum(CASE WHEN n > 1 THEN n ELSE 0 END) / sum(n), 6) FROM rp) AS repeated_ratio FROM l"""
)
def unit_statistics(spark, sf_dir):
    return units.unit_statistics(_units(spark, sf_dir))


ADJACENCY = """, nx AS (SELECT unit_text AS src, lead(unit_text) OVER (PARTITION BY asset_id, path, segment_index ORDER BY sentence_index) AS dst FROM units),
edges AS (SELECT src, dst, count(*) AS weight FROM nx WHERE dst IS NOT NULL AND src <> dst GROUP BY src, dst)
"""
ENDS = """, nodes AS (SELECT src AS node FROM edges UNION SELECT dst FROM edges),
dg AS (SELECT node, count(*) FILTER (d = 0) AS in_degree, count(*) FILTER (d = 1) AS out_degree, count(*) AS degree FROM (SELECT src AS node, 1 AS d FROM edges UNION ALL SELECT dst, 0 FROM edges) GROUP BY node)
"""


@query(UNITS + ADJACENCY + "SELECT * FROM edges")
def adjacency_edges(spark, sf_dir):
    return graphs.adjacency_edges(_units(spark, sf_dir))


@query(UNITS + "SELECT a.unit_text AS src, b.unit_text AS dst, count(*) AS weight FROM units a JOIN units b ON a.asset_id = b.asset_id AND a.path = b.path AND a.segment_index = b.segment_index AND a.sentence_index < b.sentence_index WHERE a.unit_text <> b.unit_text GROUP BY ALL")
def cooccurrence_edges(spark, sf_dir):
    return graphs.line_edges(units.split_lines(_values(spark, sf_dir)))


@query(
    UNITS
    + ADJACENCY
    + """, en AS (SELECT src AS node, * FROM edges UNION ALL SELECT dst AS node, * FROM edges), rk AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, src, dst) AS r FROM en)
SELECT DISTINCT src, dst, weight FROM rk WHERE r <= 3"""
)
def pruned_edges(spark, sf_dir):
    return graphs.pruned_pairs(graphs.adjacency_pairs(_values(spark, sf_dir)), per_node=3)


@query(UNITS + ADJACENCY + ENDS + "SELECT * FROM dg")
def node_degrees(spark, sf_dir):
    e = graphs.adjacency_edges(_units(spark, sf_dir))
    return graphs.degrees(graphs.nodes_of(e), e)


@query(
    UNITS
    + ADJACENCY
    + ENDS
    + """SELECT (SELECT count(*) FROM dg) AS node_count, (SELECT min(degree) FROM dg) AS min_degree, (SELECT max(degree) FROM dg) AS max_degree, (SELECT round(avg(degree), 6) FROM dg) AS mean_degree,
count(*) AS edge_count, min(weight) AS min_weight, max(weight) AS max_weight, round(avg(weight), 6) AS mean_weight, round(count(*) / CAST((SELECT count(*) * (count(*) - 1) FROM dg) AS DOUBLE), 12) AS density FROM edges"""
)
def graph_statistics(spark, sf_dir):
    e = graphs.adjacency_edges(_units(spark, sf_dir))
    return graphs.graph_statistics(graphs.nodes_of(e), e)


@query(UNITS + ADJACENCY + ENDS + "SELECT CASE WHEN degree >= 200 THEN '200+' ELSE CAST(degree // 5 * 5 AS VARCHAR) || '-' || CAST(degree // 5 * 5 + 4 AS VARCHAR) END AS bucket, count(*) AS n FROM dg GROUP BY bucket")
def degree_histogram(spark, sf_dir):
    e = graphs.adjacency_edges(_units(spark, sf_dir))
    return graphs.degree_histogram(graphs.degrees(graphs.nodes_of(e), e))


NODES = """WITH nodes AS (SELECT CAST(conv_id AS VARCHAR) AS asset_id, conv_id || ':' || turn AS node_id, conv_id || ':' || lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS parent_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS depth FROM conversations)
"""


@query(NODES + "SELECT asset_id, node_id, parent_id, role, depth, lead(node_id) OVER (PARTITION BY asset_id ORDER BY depth) IS NULL AS is_leaf FROM nodes")
def conversation_tree(spark, sf_dir):
    return graphs.tree_depths(graphs.conversation_nodes(table(spark, sf_dir, "conversations"))).drop("text")


@query(NODES + "SELECT min(depth) FILTER (true) AS least_depth, max(depth) AS max_depth, count(*) FILTER (parent_id IS NULL) AS roots, count(*) AS nodes FROM nodes")
def hierarchy_statistics(spark, sf_dir):
    tree = graphs.tree_depths(graphs.conversation_nodes(table(spark, sf_dir, "conversations")))
    return tree.agg(F.min("depth").alias("least_depth"), F.max("depth").alias("max_depth"), F.count_if(F.col("parent_id").isNull()).alias("roots"), F.count(F.lit(1)).alias("nodes"))


@query("SELECT c_custkey AS node, c_custkey % 25 AS component FROM customer")
def weak_components(spark, sf_dir):
    """Customers linked to the residue of their key: a graph whose components SQL can state."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    edges = c.select(k.alias("src"), (k % 25).alias("dst"))
    return graphs.weak_components(edges).join(c.select(k.alias("node")), "node", "left_semi")


CONCEPTS = """, concepts AS (SELECT sha256(t) AS concept_id, t AS unit_text FROM (SELECT DISTINCT trim(unit_text) AS t FROM units) WHERE t <> ''),
instances AS (SELECT sha256(concat_ws('|', concept_id, asset_id, path, segment_index, char_start, char_end)) AS instance_id, concept_id, asset_id, path, value_index, segment_index, sentence_index, char_start, char_end FROM units JOIN concepts USING (unit_text))
"""


def _concepts(u: DataFrame) -> DataFrame:
    return anchors.concept_declarations(u.select("unit_text", F.lit(None).cast("string").alias("decision")))


@query(UNITS + CONCEPTS + "SELECT * FROM instances")
def instances(spark, sf_dir):
    return anchors.instance_declarations(_units(spark, sf_dir))


@query(UNITS + CONCEPTS + "SELECT unit_text, count(*) AS n_instances, count(DISTINCT asset_id) AS n_assets FROM instances JOIN concepts USING (concept_id) GROUP BY unit_text ORDER BY n_instances DESC, unit_text LIMIT 100")
def top_concepts(spark, sf_dir):
    u = _units(spark, sf_dir)
    return anchors.top_concepts_of_units(u, _concepts(u))


EAV = """, cp AS (SELECT sha256(trim(unit_text)) AS concept_id, trim(unit_text) AS unit_text, * EXCLUDE (unit_text) FROM profile WHERE trim(unit_text) <> ''),
ca AS (SELECT concept_id AS object_id, unnest(['occurrence_count', 'path_diversity', 'dominant_path_ratio', 'structural_role']) AS attr_key, unnest([CAST(occurrence_count AS VARCHAR), CAST(path_diversity AS VARCHAR), CAST(dominant_path_ratio AS VARCHAR), structural_role]) AS attr_value FROM cp),
eav AS (SELECT sha256(concat_ws('|', 'concept', object_id, '', attr_key, attr_value, '', 'active', '', 'lexicarium')) AS attr_id, 'concept' AS object_type, object_id, attr_key, attr_value, 'active' AS attr_state FROM ca)
"""


def _eav(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Concepts of the units, their attributes, their instances."""
    u = _units(spark, sf_dir)
    return _concepts(u), anchors.concept_attributes(units.structure_profile(u), gate=False), anchors.instance_declarations(u)


@query(UNITS + PROFILE + EAV + "SELECT * REPLACE (CASE WHEN attr_key = 'dominant_path_ratio' THEN CAST(round(CAST(attr_value AS DOUBLE), 6) AS VARCHAR) ELSE attr_value END AS attr_value) FROM (SELECT object_type, object_id, attr_key, attr_value, attr_state FROM eav)")
def concept_attributes(spark, sf_dir):
    return _eav(spark, sf_dir)[1].drop("attr_id")


@query(UNITS + PROFILE + EAV + "SELECT unit_text, occurrence_count FROM cp ORDER BY occurrence_count DESC, unit_text LIMIT 100")
def preset_top_concepts(spark, sf_dir):
    return anchors.concepts_by(*_eav(spark, sf_dir)[:2], "occurrence_count")


@query(UNITS + PROFILE + EAV + "SELECT unit_text, path_diversity FROM cp ORDER BY path_diversity DESC, unit_text LIMIT 100")
def preset_top_concepts_by_diversity(spark, sf_dir):
    return anchors.concepts_by(*_eav(spark, sf_dir)[:2], "path_diversity")


@query(UNITS + PROFILE + EAV + "SELECT unit_text, CAST(occurrence_count AS INTEGER) AS occurrence_count, CAST(path_diversity AS INTEGER) AS path_diversity, dominant_path_ratio FROM cp WHERE occurrence_count >= 10 AND path_diversity >= 5 ORDER BY occurrence_count DESC, unit_text LIMIT 100")
def preset_high_value_concepts(spark, sf_dir):
    return anchors.high_value_concepts(*_eav(spark, sf_dir)[:2])


@query(UNITS + PROFILE + EAV + "SELECT attr_key, attr_value, attr_state FROM eav WHERE object_id = sha256('The.') ORDER BY attr_key, attr_value LIMIT 100")
def preset_concept_profile(spark, sf_dir):
    return anchors.concept_profile(*_eav(spark, sf_dir)[:2], "The.")


@query(UNITS + "SELECT asset_id, path, segment_index, char_start, char_end FROM units WHERE trim(unit_text) = 'The.' ORDER BY asset_id, path, segment_index, char_start LIMIT 100")
def preset_concept_instances(spark, sf_dir):
    concepts, _, instances_ = _eav(spark, sf_dir)
    return anchors.concept_instances(concepts, instances_, "The.")


@query(UNITS + PROFILE + EAV + "SELECT attr_key, count(*) AS n FROM eav GROUP BY attr_key")
def preset_attribute_distribution(spark, sf_dir):
    return anchors.attribute_distribution(_eav(spark, sf_dir)[1])


@query(UNITS + PROFILE + EAV + "SELECT (SELECT count(*) FROM units WHERE trim(unit_text) <> '') AS instance_count, (SELECT count(*) FROM cp) AS concept_count, (SELECT count(*) FROM eav) AS attribute_count")
def preset_table_stats(spark, sf_dir):
    concepts, attributes_, instances_ = _eav(spark, sf_dir)
    return anchors.table_stats(instance=instances_, concept=concepts, attribute=attributes_)


SYNC = "SELECT CAST(year(o_orderdate) AS VARCHAR) AS sync_id, 'orders' AS source_table, count(*) AS record_count, max(o_orderdate) AS finished_at FROM orders GROUP BY year(o_orderdate)"


@query(SYNC + " ORDER BY finished_at DESC LIMIT 100")
def preset_sync_history(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    log = o.groupBy(F.year("o_orderdate").cast("string").alias("sync_id")).agg(F.lit("orders").alias("source_table"), F.count(F.lit(1)).alias("record_count"), F.max("o_orderdate").alias("finished_at"))
    return anchors.sync_history(log)


@query(UNITS + PROFILE + EAV + "SELECT concept_id, unit_text FROM cp WHERE unit_text ILIKE '%tion%' ORDER BY unit_text LIMIT 100")
def preset_concept_search(spark, sf_dir):
    return anchors.concept_search(_eav(spark, sf_dir)[0], "TION")


@query(UNITS + PROFILE + EAV + "SELECT item_id, concept_id, unit_text, coalesce(n, 0) AS instance_count, coalesce(a, []) AS attributes FROM (SELECT item_id, sha256(trim(split_part(text, '.', 1) || '.')) AS concept_id FROM benchmark) h LEFT JOIN (SELECT concept_id, unit_text FROM cp) USING (concept_id) LEFT JOIN (SELECT sha256(trim(unit_text)) AS concept_id, count(*) AS n FROM units GROUP BY 1) USING (concept_id) LEFT JOIN (SELECT object_id AS concept_id, list_sort(list(attr_key || '=' || attr_value)) AS a FROM eav GROUP BY 1) USING (concept_id)")
def enriched_hits(spark, sf_dir):
    hits = table(spark, sf_dir, "benchmark").select("item_id", F.sha2(F.trim(F.concat(F.substring_index("text", ".", 1), F.lit("."))), 256).alias("concept_id"))
    return anchors.enriched(hits, "concept_id", *_eav(spark, sf_dir))


def _attributes(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("object_id"), "c_mktsegment", F.col("c_nationkey").cast("string").alias("c_nationkey"))
    return anchors.attribute_declarations(c, ["c_mktsegment", "c_nationkey"], "customer")


ATTRIBUTES = """WITH a AS (SELECT 'customer' AS object_type, CAST(c_custkey AS VARCHAR) AS object_id, unnest(['c_mktsegment', 'c_nationkey']) AS attr_key, unnest([c_mktsegment, CAST(c_nationkey AS VARCHAR)]) AS attr_value FROM customer),
attributes AS (SELECT sha256(concat_ws('|', object_type, object_id, attr_key, attr_value)) AS attr_id, * FROM a WHERE attr_value IS NOT NULL)
"""


@query(ATTRIBUTES + "SELECT * FROM attributes")
def attributes(spark, sf_dir):
    return _attributes(spark, sf_dir)


@query(ATTRIBUTES + "SELECT attr_key, count(*) AS n FROM attributes GROUP BY attr_key")
def attribute_distribution(spark, sf_dir):
    return anchors.attribute_distribution(_attributes(spark, sf_dir))


@query(ATTRIBUTES + "SELECT object_id, max(attr_value) FILTER (attr_key = 'c_mktsegment') AS c_mktsegment, max(attr_value) FILTER (attr_key = 'c_nationkey') AS c_nationkey FROM attributes GROUP BY object_id")
def attribute_pivot(spark, sf_dir):
    return anchors.pivoted(_attributes(spark, sf_dir), ["c_mktsegment", "c_nationkey"])


@query(ATTRIBUTES + "SELECT object_id, list_sort(list(attr_key || '=' || attr_value)) AS attributes FROM attributes GROUP BY object_id")
def attribute_lists(spark, sf_dir):
    return anchors.attribute_lists(_attributes(spark, sf_dir))


@query("SELECT 'order' AS object_type, CAST(o_custkey AS VARCHAR) AS object_id, 'status' AS attr_key, count(DISTINCT o_orderstatus) AS n_values FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1")
def attribute_conflicts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return anchors.attribute_conflicts(o.select(F.lit("order").alias("object_type"), F.col("o_custkey").cast("string").alias("object_id"), F.lit("status").alias("attr_key"), F.col("o_orderstatus").alias("attr_value")))


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def foreign_key_orphans(spark, sf_dir):
    return anchors.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_acctbal > 0"), "o_custkey", "c_custkey").select("o_orderkey")


@query("SELECT count(*) AS groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1)")
def duplicate_summary(spark, sf_dir):
    return anchors.duplicate_summary(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return anchors.duplicate_keys(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l JOIN documents e ON l.doc_id = e.doc_id WHERE e.source IS NOT DISTINCT FROM d.source AND e.lang IS NOT DISTINCT FROM d.lang AND l.toxic = 1)")
def uncovered_coordinates(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    toxic = d.join(table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id").select("source", "lang")
    return anchors.uncovered(d.select("doc_id", "source", "lang"), toxic, ["source", "lang"]).select("doc_id")


@query("SELECT 'left_only' AS side, count(*) AS n FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'right_only', count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def coverage_difference(spark, sf_dir):
    return anchors.coverage_difference(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT 'documents' AS table_name, count(*) AS n FROM documents UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'pages', count(*) FROM pages")
def table_counts(spark, sf_dir):
    return anchors.table_counts(**{n: table(spark, sf_dir, n) for n in ("documents", "labels", "pages")})


@query("SELECT doc_id, content_hash FROM (SELECT doc_id, sha256(text) AS content_hash, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src0')) WHERE r = 1")
def content_delta(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return anchors.content_delta(d.select("doc_id", "text"), d.where("source = 'src0'").select(F.sha2("text", 256).alias("content_hash"))).select("doc_id", "content_hash")


@query("SELECT 'order_customer' AS check_name, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status, count(*) AS violations FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'document_key', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)")
def integrity_audit(spark, sf_dir):
    return anchors.audit(order_customer=anchors.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey"), document_key=anchors.duplicate_keys(table(spark, sf_dir, "documents"), ["doc_id"]))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS sync_id FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def latest_snapshot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("sync_id"))
    log = o.select("sync_id").distinct().select("sync_id", F.col("sync_id").alias("finished_at"), F.lit("orders").alias("source_table"))
    return anchors.latest_snapshot(o, log, "orders")


VALUES = "WITH v AS (SELECT CAST(doc_id AS VARCHAR) AS asset_id, text AS value FROM documents)\n"


def _values(spark, sf_dir) -> DataFrame:
    return units.values_of(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")))


@query(
    VALUES
    + r"""SELECT asset_id, length(value) AS n, length(value) - length(regexp_replace(value, '\p{Nd}', '', 'g')) AS digits, length(value) - length(regexp_replace(value, '\p{P}', '', 'g')) AS punctuation, length(value) - length(regexp_replace(value, '\p{Cc}', '', 'g')) AS control, control - (length(value) - length(regexp_replace(value, '[\n\r\t]', '', 'g'))) AS control_other,
length(value) - length(regexp_replace(value, '[()\[\]{}]', '', 'g')) AS brackets, length(value) - length(regexp_replace(value, '[,.:;=]', '', 'g')) AS separators,
CASE WHEN length(value) > 0 THEN round(digits / length(value), 6) ELSE 0 END AS digit_ratio, CASE WHEN length(value) > 0 THEN round(punctuation / length(value), 6) ELSE 0 END AS punctuation_ratio FROM v"""
)
def character_ratios(spark, sf_dir):
    return profiles.character_ratios(_values(spark, sf_dir))


CHARS = ", c AS (SELECT asset_id, unnest(string_split(substr(value, 1, 1024), '')) AS ch, unnest(range(0, least(length(value), 1024))) AS pos FROM v)\n"
BLOCK_CASE = "CASE " + " ".join(f"WHEN unicode(ch) BETWEEN {lo} AND {hi} THEN '{name}'" for name, lo, hi in profiles.BLOCKS) + " ELSE 'other' END"


@query(VALUES + CHARS + ", k AS (SELECT asset_id, ch, count(*) AS n FROM c WHERE ch <> '' GROUP BY asset_id, ch) SELECT asset_id, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS entropy FROM k GROUP BY asset_id")
def value_entropy(spark, sf_dir):
    return profiles.entropy(_values(spark, sf_dir))


ALL_CHARS = ", c AS (SELECT asset_id, unnest(string_split(value, '')) AS ch, unnest(range(0, length(value))) AS pos FROM v)\n"


@query(VALUES + ALL_CHARS + f"SELECT asset_id, {BLOCK_CASE} AS block, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY asset_id), 6) AS ratio FROM c WHERE ch <> '' GROUP BY asset_id, block")
def block_distribution(spark, sf_dir):
    return profiles.block_distribution(_values(spark, sf_dir))


@query(VALUES + ALL_CHARS + f", b AS (SELECT asset_id, pos, {BLOCK_CASE} AS after FROM c WHERE ch <> ''), t AS (SELECT lag(after) OVER (PARTITION BY asset_id ORDER BY pos) AS before, after FROM b) SELECT before, after, count(*) AS n FROM t WHERE before <> after GROUP BY before, after ORDER BY n DESC, before, after LIMIT 10")
def block_transitions(spark, sf_dir):
    return profiles.block_transitions(_values(spark, sf_dir))


@query(VALUES + ALL_CHARS + f"SELECT asset_id, {BLOCK_CASE} AS block, count(*) AS n FROM c WHERE ch <> '' GROUP BY ALL")
def text_block_distribution(spark, sf_dir):
    return profiles.text_block_distribution(_values(spark, sf_dir))


@query(VALUES + ALL_CHARS + f", b AS (SELECT asset_id, pos, {BLOCK_CASE} AS after FROM c WHERE ch <> ''), t AS (SELECT lag(after) OVER (PARTITION BY asset_id ORDER BY pos) AS before, after FROM b) SELECT before, after, count(*) AS n FROM t WHERE before <> after GROUP BY before, after ORDER BY n DESC, before, after LIMIT 10")
def text_block_transitions(spark, sf_dir):
    return profiles.text_block_transitions(_values(spark, sf_dir))


@query(VALUES + ", l AS (SELECT asset_id, string_split(value, chr(10)) AS ls FROM v) SELECT asset_id, len(ls) AS lines, len(list_filter(ls, lambda x: trim(x) = '')) AS blank, len(list_filter(ls, lambda x: regexp_matches(x, '^ *[-*•] '))) AS bullets, list_max(list_transform(ls, lambda x: length(x))) AS longest FROM l")
def line_structure(spark, sf_dir):
    return profiles.line_structure(_values(spark, sf_dir))


BLOCK_ROWS = f""", k AS (SELECT asset_id, pos, ch, {BLOCK_CASE} AS block FROM c WHERE ch <> ''),
kn AS (SELECT *, row_number() OVER (PARTITION BY asset_id, block ORDER BY pos) AS nth, count(*) OVER (PARTITION BY asset_id, block) AS n, count(*) OVER (PARTITION BY asset_id) AS total FROM k),
kc AS (SELECT asset_id, block, n, total, ch, count(*) FILTER (nth <= 1024) AS q FROM kn GROUP BY ALL),
blocks AS (SELECT asset_id, block, n, round(n / total, 6) AS ratio, CASE WHEN n >= 10 THEN round(log2(sum(q)) - sum(CASE WHEN q > 0 THEN q * log2(q) ELSE 0 END) / sum(q), 6) END AS entropy FROM kc GROUP BY asset_id, block, n, total)
"""


@query(
    VALUES
    + ALL_CHARS
    + f""", kq AS (SELECT asset_id, {BLOCK_CASE} AS block, ch, count(*) AS q FROM c WHERE ch <> '' GROUP BY ALL)
SELECT asset_id, block, CAST(sum(q) AS BIGINT) AS n, round(log2(sum(q)) - sum(q * log2(q)) / sum(q), 6) AS entropy FROM kq GROUP BY asset_id, block HAVING sum(q) >= 10"""
)
def entropy_by_block(spark, sf_dir):
    return profiles.entropy_by_block(_values(spark, sf_dir))


OBSERVED = r""", ol AS (SELECT asset_id, value, string_split(value, chr(10)) AS ls, list_filter(ls, lambda x: regexp_matches(x, '\S')) AS fl FROM v WHERE value IS NOT NULL),
ot AS (SELECT asset_id, count(*) FILTER (block <> prev) AS steps FROM (SELECT asset_id, block, lag(block) OVER (PARTITION BY asset_id ORDER BY pos) AS prev FROM k) GROUP BY asset_id),
oe AS (SELECT asset_id, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS entropy FROM (SELECT asset_id, ch, count(*) AS n FROM k WHERE pos < 1024 GROUP BY ALL) GROUP BY asset_id),
obs AS (SELECT asset_id, length(value) AS n, (length(value) - length(regexp_replace(value, '[\x00-\x7f]', '', 'g'))) / length(value) AS ascii_ratio, (length(value) - length(regexp_replace(value, '\p{Nd}', '', 'g'))) / length(value) AS digit_ratio, (length(value) - length(regexp_replace(value, '\p{P}', '', 'g'))) / length(value) AS punct_ratio,
(length(value) - length(regexp_replace(value, '\p{Cc}', '', 'g'))) / length(value) AS control_ratio, (length(regexp_replace(value, '[\n\r\t]', '', 'g')) - length(regexp_replace(value, '\p{Cc}', '', 'g'))) / length(value) AS control_ratio_strict,
length(value) - length(regexp_replace(value, '[()\[\]{}]', '', 'g')) AS paired_total, length(value) - length(regexp_replace(value, '[,.:;=]', '', 'g')) AS separators_total, coalesce(oe.entropy, 0) AS entropy, len(ls) AS total_lines, list_sum(list_transform(ls, lambda x: length(x))) / len(ls) AS avg_line_length, (len(ls) - len(fl)) / len(ls) AS empty_line_ratio,
CASE WHEN len(fl) > 0 THEN len(list_filter(fl, lambda x: regexp_matches(x, '^[ \t]'))) / len(fl) ELSE 0 END AS indented_line_ratio, len(list_filter(ls, lambda x: regexp_matches(x, '[()\[\]{}]'))) / len(ls) AS paired_symbol_line_ratio, CASE WHEN len(fl) > 0 THEN len(list_filter(fl, lambda x: length(trim(x)) <= 5)) / len(fl) ELSE 0 END AS short_line_ratio,
coalesce(steps, 0) AS transition_count, CASE WHEN length(value) > 1 THEN coalesce(steps, 0) / (length(value) - 1) ELSE 0 END AS transition_density FROM ol LEFT JOIN ot USING (asset_id) LEFT JOIN oe USING (asset_id))
"""
RATIOS = ["ascii_ratio", "digit_ratio", "punct_ratio", "control_ratio", "control_ratio_strict", "entropy", "avg_line_length", "empty_line_ratio", "indented_line_ratio", "paired_symbol_line_ratio", "short_line_ratio", "transition_density"]


@query(VALUES + ALL_CHARS + BLOCK_ROWS + OBSERVED + f"SELECT asset_id, n, paired_total, separators_total, total_lines, transition_count, {', '.join(f'round({c}, 6) AS {c}' for c in RATIOS)} FROM obs")
def string_observations(spark, sf_dir):
    o = profiles.observations(_values(spark, sf_dir)).select("asset_id", "n", "unicode.*", "symbols.*", "line_structure.*", "block_transitions.*", F.col("entropy.avg").alias("entropy"))
    return o.select("asset_id", "n", "paired_total", "separators_total", "total_lines", "transition_count", *[F.round(c, 6).alias(c) for c in RATIOS])


@query(
    VALUES
    + ALL_CHARS
    + BLOCK_ROWS
    + OBSERVED
    + """, rl AS (SELECT asset_id, indented_line_ratio >= 0.3 AND paired_symbol_line_ratio >= 0.3 AS protect, EXISTS (SELECT 1 FROM blocks b WHERE b.asset_id = o.asset_id AND ratio >= 0.5 AND b.entropy <= 1.5) AS junk, control_ratio_strict > 0.05 AS frozen, control_ratio_strict > 0.01 AS late, entropy > 5.5 AND transition_density > 0.4 AS damage FROM obs o)
SELECT asset_id, CASE WHEN junk OR frozen THEN 'FREEZE' WHEN (late OR damage) AND NOT protect THEN 'DELAY' ELSE 'ALLOW' END AS decision,
list_filter([CASE WHEN protect THEN 'allow_structured_content:line_structure.indented_line_ratio' END, CASE WHEN protect THEN 'allow_structured_content:line_structure.paired_symbol_line_ratio' END, CASE WHEN junk THEN 'freeze_repetitive_dominant_block:_composite:dominant_block_low_entropy' END, CASE WHEN frozen THEN 'freeze_extreme_control_chars:unicode.control_ratio_strict' END, CASE WHEN late THEN 'delay_control_char_ratio:unicode.control_ratio_strict' END, CASE WHEN damage THEN 'delay_encoding_damage:entropy.avg' END, CASE WHEN damage THEN 'delay_encoding_damage:block_transitions.transition_density' END], lambda x: x IS NOT NULL) AS triggered FROM rl"""
)
def eligibility(spark, sf_dir):
    v = _values(spark, sf_dir)
    return profiles.eligibility(profiles.with_blocks(profiles.observations(v), v))


@query(r"WITH v AS (SELECT CAST(doc_id AS VARCHAR) AS asset_id, '/' || source || '/' || lang AS path, least(length(text), 8000) AS chars FROM documents WHERE text IS NOT NULL), r AS (SELECT *, row_number() OVER w AS r, coalesce(sum(chars) OVER (PARTITION BY path ORDER BY md5('42|' || asset_id || '|0'), asset_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM v WINDOW w AS (PARTITION BY path ORDER BY md5('42|' || asset_id || '|0'), asset_id)) SELECT asset_id, path, 0 AS value_index, chars FROM r WHERE r <= 20 AND b + chars <= 40000")
def sampled_values(spark, sf_dir):
    return profiles.sampled_values(_values(spark, sf_dir), most=20, total_chars=40_000)


ANNOTATIONS = "WITH n AS (SELECT event_id AS annotation_id, user_id AS anchor_id, ts AS event_time, ts + INTERVAL 1 HOUR AS ingested_at, event_type AS annotation_type, props AS body, lag(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS supersedes FROM events)\n"


def _annotations(spark, sf_dir) -> DataFrame:
    return retrieval.annotations_of(table(spark, sf_dir, "events"))


@query(ANNOTATIONS + "SELECT * FROM n WHERE annotation_type IN ('click', 'error') AND event_time >= TIMESTAMP '2024-01-05' AND event_time < TIMESTAMP '2024-02-01' AND event_time <= TIMESTAMP '2024-01-20' AND ingested_at <= TIMESTAMP '2024-01-20'")
def as_of_annotations(spark, sf_dir):
    return retrieval.selected(_annotations(spark, sf_dir), ["click", "error"], "2024-01-05", "2024-02-01", "2024-01-20")


@query(ANNOTATIONS + "SELECT * FROM n a WHERE NOT EXISTS (SELECT 1 FROM n b WHERE b.supersedes = a.annotation_id)")
def current_revisions(spark, sf_dir):
    return retrieval.current_revisions(_annotations(spark, sf_dir))


@query(ANNOTATIONS + "SELECT * FROM n a WHERE ingested_at <= TIMESTAMP '2024-01-20' AND event_time <= TIMESTAMP '2024-01-20' AND NOT EXISTS (SELECT 1 FROM n b WHERE b.supersedes = a.annotation_id AND b.ingested_at <= TIMESTAMP '2024-01-20' AND b.event_time <= TIMESTAMP '2024-01-20')")
def current_revisions_as_of(spark, sf_dir):
    return retrieval.current_revisions(retrieval.selected(_annotations(spark, sf_dir), as_of="2024-01-20"))


@query("SELECT doc_id, text FROM documents WHERE contains(lower(text), 'thing. the')")
def text_search(spark, sf_dir):
    return retrieval.containing(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "THING. The")


@query("SELECT doc_id, n_chars, true AS has_more FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50 OFFSET 10")
def paged_documents(spark, sf_dir):
    return retrieval.page(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 50, 10)


@query("SELECT conv_id, turn FROM (SELECT *, sum(strlen(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS b FROM conversations) WHERE b <= 1000")
def context_budget(spark, sf_dir):
    return retrieval.within_bytes(table(spark, sf_dir, "conversations"), "text", ["conv_id"], ["turn"], 1000).select("conv_id", "turn")


QUERY_VECTOR = [((i * 37) % 64 - 31.5) / 32 for i in range(64)]


@query(f"WITH d AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings) SELECT vec_id, round(1 - list_cosine_similarity(e, {QUERY_VECTOR}), 6) AS distance FROM d ORDER BY distance, vec_id LIMIT 20")
def nearest_vectors(spark, sf_dir):
    return retrieval.nearest(table(spark, sf_dir, "embeddings"), QUERY_VECTOR, 20)


@query("SELECT vec_id, 'dimension' AS problem FROM embeddings WHERE len(embedding) <> 64")
def vector_problems(spark, sf_dir):
    return retrieval.vector_problems(table(spark, sf_dir, "embeddings"), 64)


STORES = "WITH a AS (SELECT doc_id AS object_id, sha256('id=' || doc_id || '|mark=' || coalesce(CAST(toxic AS VARCHAR), 'NULL')) AS signature FROM (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id)), b AS (SELECT doc_id AS object_id, sha256('id=' || doc_id || '|mark=' || CASE WHEN n_chars > 4000 THEN '1' ELSE '0' END) AS signature FROM documents)\n"


def _stores(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two stores of marks: the labelled documents, and all documents marked by their length."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("mark"))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") > 4000).cast("int").alias("mark"))
    sign = lambda t: t.select(F.col("doc_id").alias("object_id"), retrieval.embedding_signature({"mark": F.col("mark"), "id": F.col("doc_id")}).alias("signature"))
    return sign(labels), sign(docs)


@query(STORES + "SELECT CASE WHEN a.object_id IS NULL THEN 'orphan' WHEN b.object_id IS NULL THEN 'missing' ELSE 'drift' END AS kind, count(*) AS n FROM a FULL JOIN b ON a.object_id = b.object_id WHERE a.signature IS DISTINCT FROM b.signature GROUP BY 1")
def store_differences(spark, sf_dir):
    return retrieval.store_differences(*_stores(spark, sf_dir))


@query(STORES + "SELECT a.object_id, CASE WHEN b.object_id IS NULL THEN 'active' WHEN a.signature = b.signature THEN 'duplicate' ELSE 'replace' END AS state FROM a LEFT JOIN b ON a.object_id = b.object_id")
def embedding_lifecycle(spark, sf_dir):
    return retrieval.lifecycle(*_stores(spark, sf_dir))


@query("""WITH l AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS link FROM pages) SELECT page_id, link, lower(regexp_extract(link, '^https?://([^/:?#]+)', 1)) AS host FROM l""")
def page_links(spark, sf_dir):
    return files.links(table(spark, sf_dir, "pages"))


@query("SELECT page_id, CASE WHEN lower(ltrim(substr(html, 1, 256))) LIKE '<!doctype html%' OR lower(ltrim(substr(html, 1, 256))) LIKE '<html%' THEN 'html' ELSE 'unknown' END AS kind FROM pages")
def sniffed_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", files.sniffed(F.col("html").cast("binary"), F.col("url")).alias("kind"))


@query(r"SELECT doc_id, lower(regexp_replace(regexp_replace(trim(text, chr(10) || ' '), '\s+', ' ', 'g'), '([!]){2,}|([?]){2,}|([.]){2,}|([,]){2,}|([;]){2,}|([:]){2,}', '\1\2\3\4\5\6', 'g')) AS variant FROM documents")
def normalised_variants(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normalise_variant(F.col("text")).alias("variant"))


@query("SELECT o_orderkey, quarter(o_orderdate) AS q, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS q_start, strftime(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS q_end FROM orders")
def quarter_bounds(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    b = temporal.quarter_bounds(F.year("o_orderdate"), F.quarter("o_orderdate"))
    return o.select("o_orderkey", F.quarter("o_orderdate").alias("q"), b["start"].cast("string").alias("q_start"), b["end"].cast("string").alias("q_end"))


@query("SELECT role, count(*) AS n FROM conversations GROUP BY role")
def role_counts(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy(graphs.canonical_role(F.col("role")).alias("role")).agg(F.count(F.lit(1)).alias("n"))


from lexicarium.plans import ledgers, mechanisms, reports  # noqa: E402, F401  registers their queries beside these
