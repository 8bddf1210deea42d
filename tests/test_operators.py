"""Hand-made cases of the operators: coordinates, ties, nulls, boundaries, streams."""

import collections
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lexicarium.functions import temporal, text
from lexicarium.operators import anchors, graphs, profiles, retrieval, units
from lexicarium.sources import files
from lexicarium.streaming import delta

VALUE = "asset_id string, path string, value_index long, value string"


def test_split_keeps_exact_offsets(spark):
    value = "A. B!!\n\n 。C"
    got = units.split_units(spark.createDataFrame([("x", "/t", None, value), ("y", "/t", 0, None), ("z", "/t", 0, "")], VALUE)).orderBy("char_start").collect()
    assert [(r.segment_index, r.sentence_index, r.unit_text, r.char_start, r.char_end) for r in got] == [(0, 0, "A.", 0, 2), (0, 1, "B!!", 3, 6), (1, 0, "。", 9, 10), (1, 1, "C", 10, 11)]
    assert all(value[r.char_start : r.char_end] == r.unit_text for r in got)
    import hashlib

    assert got[0].unit_id == hashlib.sha1(b"x|/t||0|0|0|2").hexdigest()


def test_offsets_match_the_text_everywhere(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    u = units.split_units(units.values_of(d)).join(d.select(F.col("doc_id").cast("string").alias("asset_id"), "text"), "asset_id")
    assert u.where(text.located(F.col("text"), F.col("char_start"), F.col("char_end")) != F.col("unit_text")).count() == 0


def test_numeric_text_gives_its_reason_twice(spark):
    got = {r.unit_text: (r.verdict, r.reasons) for r in units.noise_verdict(spark.createDataFrame([("123",), ("word",), ("!?",)], "unit_text string")).collect()}
    assert got["123"] == ("DROP", ["numeric_only", "numeric_only"]) and got["word"] == ("KEEP", [])
    assert got["!?"] == ("DROP", ["pure_punctuation"])
    more = {r.unit_text: r.reasons for r in units.noise_verdict(spark.createDataFrame([("",), ("a",), ("--",), ("**",), ("-*",), ("²",)], "unit_text string")).collect()}
    assert more == {"": ["empty_unit_text", "below_min_length"], "a": ["below_min_length"], "--": ["symbol_only", "repeated_symbols"], "**": ["symbol_only", "repeated_symbols"], "-*": ["symbol_only"], "²": ["below_min_length"]}


def unit_rows(spark, rows):
    return spark.createDataFrame([(a, p, 0, s, i, 0, len(t), t, f"{a}{s}{i}{p}") for a, p, s, i, t in rows], "asset_id string, path string, value_index long, segment_index long, sentence_index long, char_start long, char_end long, unit_text string, unit_id string")


def test_dominant_path_tie_takes_the_larger(spark):
    row = units.structure_profile(unit_rows(spark, [("1", "a", 0, 0, "t"), ("2", "b", 0, 0, "t")])).first()
    assert row.dominant_path == "b" and row.dominant_path_ratio == 0.5


def test_boundary_small_sample_and_cross_ratio(spark):
    got = {r.unit_text: r for r in units.boundary_profile(unit_rows(spark, [("1", "a", 0, 0, "s"), ("2", "a", 1, 0, "s"), *[(str(i), "a", 0, 0, "t") for i in range(3)], ("9", "a", 1, 0, "t"), *[(str(i), "a", 0, 1, "one") for i in range(4)]])).collect()}
    assert (got["s"].boundary_status, got["s"].boundary_issues, got["s"].segment_cross_ratio) == ("OK", ["insufficient_sample"], None)
    assert (got["t"].segment_cross_ratio, got["t"].boundary_status, got["t"].boundary_issues) == (0.25, "UNSTABLE", ["segment_crossing_frequent"])
    assert got["one"].segment_cross_ratio == 0 and got["one"].boundary_status == "OK" and got["one"].length_variance == 0


def test_roles_and_prominence_follow_the_policy(spark):
    rows = [(str(i), f"p{i % 3}", i % 2, 0, "st") for i in range(6)] + [("1", "p0", 0, 1, "in"), *[(str(i), f"p{i % 2}", 0, 2, "di") for i in range(4)]]
    profile = units.structure_profile(unit_rows(spark, rows))
    assert {r.unit_text: r.structural_role for r in profile.collect()} == {"st": "stable", "in": "incidental", "di": "diffuse"}
    boundary = spark.createDataFrame([("st ", "OK", None), ("in", "OK", "high"), ("di", "ANOMALOUS", None)], "unit_text string, boundary_status string, noise_risk string")
    got = {r.unit_text: (r.decision, r.audit_confidence, r.join_status) for r in units.prominence(profile, boundary).collect()}
    assert got == {"st": ("ALLOW", 1.0, "hit"), "in": ("FREEZE", 0.75, "hit"), "di": ("DELAY", 0.5, "hit")}
    assert {r.decision for r in units.prominence(profile, boundary.limit(0)).collect()} == {"DELAY"}
    assert units.register(units.prominence(profile, boundary)).count() == 1


def test_positions(spark):
    cases = [(0, 0, "early"), (1, 3, "middle"), (2, 3, "middle"), (3, 3, "late")]
    got = spark.createDataFrame(cases, "s int, m int, want string").withColumn("b", units.position_bucket(F.col("s"), F.col("m"))).collect()
    assert all(r.b == r.want for r in got)


def test_nearest_rank_percentile(spark):
    row = units.unit_statistics(spark.createDataFrame([("x" * i,) for i in range(1, 11)], "unit_text string")).first()
    assert (row.p90, row.median_length, row.unit_count, row.near_empty) == (10, 5.5, 10, 2)


def test_eligibility_order(spark):
    """An override cancels DELAY but not FREEZE; then a missing metric raises ALLOW to DELAY."""
    one = "struct<indented_line_ratio: double, paired_symbol_line_ratio: double>"
    rows = [("o", (1.0, 1.0), (0.02,), 3.0, []), ("f", (1.0, 1.0), (0.06,), 3.0, []), ("n", (1.0, 1.0), (None,), 3.0, []), ("d", (0.0, 0.0), (0.02,), 3.0, []), ("j", (0.0, 0.0), (0.0,), 3.0, [("greek", 0.5, 1.5)]), ("s", (0.0, 0.0), (0.0,), 3.0, [("greek", 0.9, None)]), ("e", (0.0, 0.0), (0.0,), 6.0, [])]
    m = spark.createDataFrame(rows, f"asset_id string, line_structure {one}, unicode struct<control_ratio_strict: double>, bits double, blocks array<struct<block: string, ratio: double, entropy: double>>")
    m = m.withColumn("entropy", F.struct(F.col("bits").alias("avg"))).withColumn("block_transitions", F.struct(F.lit(0.5).alias("transition_density")))
    got = {r.asset_id: r.decision for r in profiles.eligibility(m).collect()}
    assert got == {"o": "ALLOW", "f": "FREEZE", "n": "DELAY", "d": "DELAY", "j": "FREEZE", "s": "ALLOW", "e": "DELAY"}
    hits = {r.asset_id: r.triggered for r in profiles.eligibility(m).collect()}
    assert hits["e"] == ["delay_encoding_damage:entropy.avg", "delay_encoding_damage:block_transitions.transition_density"] and hits["s"] == []
    assert {r.decision for r in profiles.eligibility(m.drop("unicode")).collect()} == {"DELAY", "FREEZE"}  # the metric is missing everywhere


def test_blocks_are_counted_after_the_first_1024_characters(spark):
    v = spark.createDataFrame([("a", "", 0, "x" * 1_100 + "жж 日\ue003😀é"), ("b", "", 0, ""), ("c", "", 0, None)], VALUE)
    got = {(r.asset_id, r.block): r.n for r in profiles.text_block_distribution(v).collect()}
    assert got == {("a", "basic_latin"): 1_101, ("a", "cyrillic"): 2, ("a", "cjk_unified"): 1, ("a", "other"): 1, ("a", "emoticons"): 1, ("a", "latin_supplement"): 1}
    steps = {(r.before, r.after): r.n for r in profiles.text_block_transitions(v).collect()}
    assert steps == {p: 1 for p in [("basic_latin", "cyrillic"), ("cyrillic", "basic_latin"), ("basic_latin", "cjk_unified"), ("cjk_unified", "other"), ("other", "emoticons"), ("emoticons", "latin_supplement")]}


def test_graph_density_and_isolated_nodes(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 2), ("c", "a", 3)], "src string, dst string, weight int")
    one = spark.createDataFrame([("a",)], "node string")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    assert graphs.graph_statistics(nodes, edges).first().density == 0.5
    assert graphs.graph_statistics(one, edges.limit(0)).first().density == 0.0
    assert graphs.degrees(nodes.union(spark.createDataFrame([("z",)], "node string")), edges).where("node = 'z'").first().degree == 0


def test_tree_orphans_have_depth_minus_one(spark):
    nodes = spark.createDataFrame([("r", None), ("a", "r"), ("b", "a"), ("o", "gone"), ("p", "o"), ("x", "y"), ("y", "x")], "node_id string, parent_id string")
    got = {r.node_id: (r.depth, r.is_leaf) for r in graphs.tree_depths(nodes, most=64).collect()}
    assert got == {"r": (0, False), "a": (1, False), "b": (2, True), "o": (-1, False), "p": (-1, True), "x": (-1, False), "y": (-1, False)}


def test_depths_of_a_very_long_conversation(spark):
    turns = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").cast("int").alias("turn"), F.lit("user").alias("role"), F.lit("t").alias("text"))
    tree = graphs.tree_depths(graphs.conversation_nodes(turns).unionByName(spark.createDataFrame([("2", "x", "y", "user", "t"), ("2", "y", "x", "user", "t")], "asset_id string, node_id string, parent_id string, role string, text string")))
    assert tree.where("asset_id = '1'").where(F.col("node_id") != F.concat(F.lit("1:"), F.col("depth").cast("string"))).count() == 0
    assert tree.where("depth = -1").count() == 2 and tree.agg(F.max("depth")).first()[0] == 19_999


def test_neighbourhood_is_bounded(spark):
    edges = spark.createDataFrame([(i, i + 1, 1) for i in range(10)], "src long, dst long, weight int")
    got = {r.node: r.hop for r in graphs.neighbourhood(edges, spark.createDataFrame([(5,)], "node long"), hops=9).collect()}
    assert got == {n: abs(n - 5) for n in range(1, 10)}


def test_large_containers_are_reported(spark):
    u = unit_rows(spark, [("1", "a", 0, i, f"u{i}") for i in range(5)])
    assert graphs.cooccurrence_edges(u, most=4).count() == 0 and graphs.skipped_containers(u, most=4).first().n == 1
    assert graphs.cooccurrence_edges(u).count() == 10


def test_cooccurrence_counts_every_pair_of_large_containers(spark):
    texts = {0: [f"u{i % 9 if i % 3 else i}" for i in range(1_203)], 1: [f"u{i % 7}" for i in range(500)], 2: ["u1", "u2", "u1"]}
    got = {(r.src, r.dst): r.weight for r in graphs.cooccurrence_edges(unit_rows(spark, [("1", "a", s, i, t) for s, ts in texts.items() for i, t in enumerate(ts)]).withColumn("value_index", F.lit(None).cast("long"))).collect()}
    assert got == collections.Counter((a, b) for ts in texts.values() for i, a in enumerate(ts) for b in ts[i + 1 :] if a != b)


def test_append_counts_conserve_and_merge_replaces(spark):
    new = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string")
    old = spark.createDataFrame([(2, "z"), (3, "c")], "k long, v string")
    r = anchors.append_counts(new, old, ["k"]).first()
    assert (r.seen, r.inserted, r.duplicates) == (3, 1, 2)
    assert sorted(map(tuple, anchors.merged(old, new.distinct(), ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_null_safe_anchor_matches(spark):
    a = spark.createDataFrame([("x", None), ("y", 1)], "p string, i long")
    assert [r.p for r in anchors.uncovered(a, a.where("p = 'x'"), ["p", "i"]).collect()] == ["y"]


def test_attributes_gate_and_conflicts(spark):
    d = anchors.concept_declarations(spark.createDataFrame([(" a ", "ALLOW"), ("a", None), ("b", "DELAY"), ("", None)], "unit_text string, decision string"))
    assert [r.unit_text for r in d.collect()] == ["a"]


def test_search_treats_wildcards_as_text(spark):
    rows = spark.createDataFrame([("s1", "at 20C"), ("s2", "20c dry"), ("s3", "40%_C")], "object_id string, text string")
    assert retrieval.containing(rows, "text", "20C").count() == 2 and retrieval.containing(rows, "text", "%_").count() == 1 and retrieval.containing(rows, "text", "_0").count() == 0


def test_as_of_keeps_the_parent_current(spark):
    t = dt.datetime
    rows = spark.createDataFrame([(1, t(2024, 1, 1), t(2024, 1, 1), None), (2, t(2024, 1, 5), t(2024, 1, 6), 1)], "annotation_id long, event_time timestamp, ingested_at timestamp, supersedes long")
    current = lambda at: [r.annotation_id for r in retrieval.current_revisions(retrieval.selected(rows, as_of=at)).collect()]
    assert current("2024-01-05 12:00:00") == [1] and current("2024-01-07") == [2]


def test_vector_problems(spark):
    v = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [float("nan"), 1.0]), (4, None), (5, [float("inf"), 0.0])], "vec_id long, embedding array<float>")
    assert {r.vec_id: r.problem for r in retrieval.vector_problems(v, 2).collect()} == {2: "dimension", 3: "not_finite", 4: "missing", 5: "not_finite"}


def test_temporal_mentions():
    assert [m[0] for m in temporal.date_mentions("于2024年3月5日")] == ["cn_full_date"]
    assert list(temporal.date_mentions("昨天, 2024-02", dt.date(2024, 3, 1)))[0][3] == dt.date(2024, 2, 29)
    assert list(temporal.date_mentions("2023年2月"))[0][3:] == (dt.date(2023, 2, 1), dt.date(2023, 2, 28))
    assert [temporal.chinese_integer(x) for x in ("十二", "二百零三", "二〇二四", "7", "x")] == [12, 203, 2024, 7, None]


def test_temporal_table_function_and_bounds(spark):
    spark.udtf.register("temporal_annotations", temporal.TemporalAnnotations)
    rows = spark.sql("select t.id, a.* from values (1, '2024年3月5日'), (2, 'none') t(id, s), lateral temporal_annotations(s, date'2024-01-01') a").collect()
    assert [(r.id, r.kind) for r in rows] == [(1, "cn_full_date")]
    r = spark.range(1).select(temporal.season_bounds(F.lit(2023), F.lit("winter")).alias("w"), temporal.month_bounds(F.lit(2024), F.lit(2)).alias("m")).first()
    assert r.w.end == dt.date(2024, 2, 29) and r.m.end == dt.date(2024, 2, 29)


def test_parse_utc_status(spark):
    got = [r.s for r in spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00",), ("nope",), (None,)], "t string").select(temporal.parse_utc(F.col("t"))["status"].alias("s")).collect()]
    assert got == ["resolved", "ambiguous", "invalid", "missing"]


def test_text_functions(spark):
    r = spark.createDataFrame([(" Ａb\r\nC  d！！", ["a"], [])], "t string, a array<string>, b array<string>").select(text.canonical(F.col("t")).alias("c"), text.normalise_variant(F.col("t")).alias("v"), text.jaccard(F.col("a"), F.col("b")).alias("j"), text.jaccard(F.col("b"), F.col("b")).alias("e")).first()
    assert r.c == "ab c d!!" and r.v.endswith("d!") and (r.j, r.e) == (0.0, 1.0)


def test_json_lines_keep_bad_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\nnot json\n\n{"a": 2}\n{"a": "x"}\n')
    good, bad = files.json_lines(spark, str(tmp_path), "a long")
    assert sorted(r.a for r in good.collect()) == [1, 2] and sorted(r._corrupt for r in bad.collect()) == ["not json", '{"a": "x"}']
    assert good.columns == ["a", "_file"] and bad.first()._file.endswith("a.jsonl")


def test_inventory_and_duplicates(spark, tmp_path):
    for name, data in (("x.bin", b"%PDF-1"), ("y.pdf", b"%PDF-1"), ("z.txt", b"plain"), ("j.dat", b' {"a":1}')):
        (tmp_path / name).write_bytes(data)
    inv = files.inventory(spark, str(tmp_path))
    assert {r.path.split("/")[-1]: r.kind for r in inv.collect()} == {"x.bin": "pdf", "y.pdf": "pdf", "z.txt": "txt", "j.dat": "json"}
    assert files.duplicate_files(inv).first().n == 2


def test_conversation_exports(spark):
    mapping = json.dumps({"id": "c", "title": "t", "mapping": {"r": {"id": "r", "parent": None, "children": ["a"]}, "a": {"id": "a", "parent": "r", "children": [], "message": {"author": {"role": "user"}, "content": {"parts": ["x", "y"]}, "create_time": 1.5}}}})
    chat = json.dumps({"uuid": "d", "chat_messages": [{"uuid": "1", "sender": "human", "text": "q", "created_at": "2024-01-01T00:00:00Z"}, {"uuid": "2", "sender": "assistant", "text": "z"}]})
    raw = spark.createDataFrame([(mapping,), (chat,), ("{}",), (json.dumps({"mapping": {}, "chat_messages": []}),)], "json string")
    assert sorted(r.format for r in files.detect_export(raw).collect()) == ["ambiguous", "chat", "mapping", "rejected"]
    got = {(r.conversation_id, r.node_id, r.value_index): (r.parent_id, r.role, r.text) for r in files.canonical_nodes(raw).collect()}
    assert got == {("c", "r", None): (None, None, None), ("c", "a", 0): ("r", "user", "x"), ("c", "a", 1): ("r", "user", "y"), ("d", "1", 0): (None, "human", "q"), ("d", "2", 0): ("1", "assistant", "z")}


def test_snapshots_and_stream_delta(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "id long, text string"
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], schema).coalesce(1).write.parquet(src)
    stream = delta.new_content(delta.read_documents(spark, src, schema))
    delta.append_batches(stream, out, str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([(4, "b"), (5, "c")], schema).write.mode("append").parquet(src)
    delta.append_batches(delta.new_content(delta.read_documents(spark, src, schema)), out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    snap = str(tmp_path / "snap")
    for s in ("s1", "s2"):
        files.append_snapshot(spark.createDataFrame([(1, s)], "id long, v string"), snap, s)
    log = spark.createDataFrame([("s1", "t", 1), ("s2", "t", 2)], "sync_id string, source_table string, finished_at long")
    assert [r.v for r in anchors.latest_snapshot(spark.read.parquet(snap), log, "t").collect()] == ["s2"]


@pytest.mark.parametrize("rows, conflict", [([(1, None), (2, 1)], 0), ([(1, None), (2, 1), (3, 1)], 1)])
def test_conflicting_revisions(spark, rows, conflict):
    assert retrieval.conflicts(spark.createDataFrame(rows, "annotation_id long, supersedes long")).count() == conflict


def test_components_match_a_plain_union_find(spark):
    from lexicarium.plans.queries import _units

    e = graphs.adjacency_edges(_units(spark, "/root/testdata/sf0.001"))
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for r in e.collect():
        a, b = top(r.src), top(r.dst)
        parent[max(a, b)] = min(a, b)
    got = graphs.weak_components(e)
    assert {r.node: r.component for r in got.collect()} == {x: top(x) for x in parent}
    sizes = collections.Counter(top(x) for x in parent)
    assert tuple(graphs.component_summary(got).first()) == (len(sizes), max(sizes.values()))


def test_packing_skips_what_does_not_fit(spark):
    rows = [(g, i, "x" * n) for g in range(3) for i, n in enumerate((5, 9, 3, 20, 2, 1))] + [(7, 0, None), (7, 1, "é" * 3)]
    expect = set()
    for g in {r[0] for r in rows}:
        left = 10
        for _, i, t in sorted(r for r in rows if r[0] == g and r[2] is not None):
            if len(t.encode()) <= left:
                left -= len(t.encode())
                expect.add((g, i))
    got = retrieval.packed(spark.createDataFrame(rows, "g long, i long, t string").repartition(5), "t", "g", ["i"], 10)
    assert {(r.g, r.i) for r in got.collect()} == expect and got.columns == ["g", "i"]


def test_json_nodes_and_record_arrays(spark):
    from lexicarium.operators import structure

    docs = [(1, json.dumps({"m": {"123e4567-e89b-12d3-a456-426614174000": {"a": 1}}, "l": [{"x": 1, "y": None}, {"x": 2, "y": True}], "s": ["t", 3]})), (2, "{bad"), (3, None), (4, "[]")]
    nodes = structure.json_nodes(spark.createDataFrame(docs, "id long, j string"), "id", "j")
    got = collections.Counter((r.id, r.path, r.type) for r in nodes.collect())
    assert got == collections.Counter([(1, "", "object"), (1, "/m", "object"), (1, "/m/**", "object"), (1, "/m/**/a", "number"), (1, "/l", "array"), (1, "/l/*", "object"), (1, "/l/*", "object"), (1, "/l/*/x", "number"), (1, "/l/*/x", "number"), (1, "/l/*/y", "null"), (1, "/l/*/y", "boolean"), (1, "/s", "array"), (1, "/s/*", "string"), (1, "/s/*", "number"), (4, "", "array")])
    assert [(r.path, r.items, r.confidence) for r in structure.record_arrays(nodes).collect()] == [("/l/*", 2, "high")]
    assert [(r.path, r.text) for r in structure.string_leaves(nodes, ["/s/*"]).collect()] == [("/s/*", "t")]


def test_temporal_rules(spark):
    ref = dt.date(2024, 3, 31)
    day = lambda *a: dt.date(*a)
    cases = {
        "2024年3月5日": [("cn_full_date", day(2024, 3, 5), day(2024, 3, 5))],
        "2023年12月至2024年2月": [("cn_date_range", day(2023, 12, 1), day(2024, 2, 29))],
        "2024年第二季度": [("quarter", day(2024, 4, 1), day(2024, 6, 30))],
        "2023年冬": [("season", day(2023, 12, 1), day(2024, 2, 29))],
        "一个月前": [],
        "1个月前": [("numeric_relative", day(2024, 2, 29), day(2024, 2, 29))],
        "两周后": [("numeric_relative", day(2024, 4, 14), day(2024, 4, 14))],
        "上个月": [("simple_relative", day(2024, 2, 1), day(2024, 2, 29))],
        "明年": [("simple_relative", day(2025, 1, 1), day(2025, 12, 31))],
        "每周": [("recurring", None, None)],
        "三天": [("duration", None, None)],
        "2024年": [("year", day(2024, 1, 1), day(2024, 12, 31))],
        "2024-02-30": [],
    }
    for text_, want in cases.items():
        if text_ == "一个月前":
            want = [("numeric_relative", day(2024, 2, 29), day(2024, 2, 29))]
        assert [(k, a, b) for k, _, _, a, b in temporal.date_mentions(text_, ref)] == want, text_


def test_replay_digest_is_order_free_and_sees_changes(spark):
    from lexicarium.operators import audits

    d = spark.createDataFrame([(i, f"t{i}", i) for i in range(50)], "id long, t string, generated_at long")
    one = audits.replay_digest(d, ["id"]).first()
    assert one == audits.replay_digest(d.orderBy(F.desc("id")).withColumn("generated_at", F.lit(0).cast("long")), ["id"]).first() and one.rows == 50
    assert audits.replay_digest(d.withColumn("t", F.when(F.col("id") == 3, None).otherwise(F.col("t"))), ["id"]).first().digest != one.digest
    assert [tuple(r) for r in audits.record_differences(d, d.where("id > 0").withColumn("t", F.when(F.col("id") == 3, "x").otherwise(F.col("t"))), ["id"]).orderBy("id").collect()] == [(0, "left_only"), (3, "changed")]


def test_boundary_of_a_text_whose_squared_length_passes_an_int(spark):
    row = units.boundary_profile(unit_rows(spark, [(str(i), "a", 0, 0, "x" * 50_001) for i in range(3)])).first()
    assert (row.boundary_status, row.length_variance, row.length_min, row.length_max) == ("OK", 0, 50_001, 50_001)
    assert dict(units.boundary_profile(unit_rows(spark, [("1", "a", 0, 0, "t")])).dtypes)["length_min"] == "int"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_block_measures_need_no_row_a_character(spark):
    v = spark.createDataFrame([("a", "/p", 0, "ab" * 20 + "éé" + "αβ" * 6 + "\U0001f600" * 12 + "\U00020000" * 10), ("b", "/p", 0, ""), ("c", "/p", 0, None)], VALUE)
    got = {r.block: (r.n, r.entropy) for r in profiles.entropy_by_block(v).collect()}
    assert got == {"basic_latin": (40, 1.0), "greek": (12, 1.0), "emoticons": (12, 0.0), "other": (10, 0.0)}
    assert {(r.asset_id, r.block): (r.n, r.ratio) for r in profiles.block_distribution(v).collect()}["a", "latin_supplement"] == (2, round(2 / 76, 6))
    assert "Generate" not in physical(profiles.entropy_by_block(v)) and "Generate" not in physical(profiles.text_block_distribution(v))
    o = profiles.observations(v)
    assert {r.asset_id: (r.block_transitions.transition_count, r.n) for r in o.collect()} == {"a": (4, 76), "b": (0, 0)}
    assert "Exchange" not in physical(o)
    assert [b.block for b in profiles.with_blocks(o, v).where("asset_id = 'a'").first().blocks] == ["basic_latin", "emoticons", "greek", "latin_supplement", "other"]


def test_units_are_cut_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(units, "BATCH", 2)
    value = " A。B?\x1f　\r\n  \n\x0bc d\t"
    got = units.split_units(spark.createDataFrame([("x", "/t", 3, value), ("y", None, 1, "q! r? s.")], VALUE)).orderBy("asset_id", "char_start").collect()
    assert [(r.asset_id, r.path, r.value_index, r.segment_index, r.sentence_index, r.unit_text) for r in got] == [("x", "/t", 3, 0, 0, "A。"), ("x", "/t", 3, 0, 1, "B?"), ("x", "/t", 3, 0, 2, "\x1f"), ("x", "/t", 3, 1, 0, "c d"), *[("y", None, 1, 0, k, t) for k, t in enumerate(("q!", "r?", "s."))]]
    assert all(value[r.char_start : r.char_end] == r.unit_text for r in got if r.asset_id == "x")
    assert "Generate" not in physical(units.split_units(spark.createDataFrame([], VALUE)))


def test_replay_spreads_with_the_session_and_not_over_seven_tasks(spark):
    from lexicarium.plans import reports

    plan = reports.replay_differences(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(unit_id" in plan and "hashpartitioning(char_start" not in plan


def test_components_by_contraction(spark):
    chain = [(f"p{i}", f"p{i + 1}") for i in range(40)] + [("loop", "loop"), ("x", "y"), ("y", "x"), (None, "z")]
    edges = spark.createDataFrame(chain, "src string, dst string")
    got = {r.node: r.component for r in graphs.weak_components(edges).collect()}
    assert got == {f"p{i}": "p0" for i in range(41)} | {"loop": "loop", "x": "x", "y": "x"}
    keyed = edges.select(*[graphs.short_key(c).alias(c) for c in ("src", "dst")])
    assert tuple(graphs.size_summary(graphs.component_sizes(keyed)).first()) == (3, 41)
