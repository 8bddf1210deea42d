"""Hierarchies, byte-budget batches, array files, closures, published tables, graph merges and append ledgers against plain versions."""

import collections
import hashlib
import io
import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from lexicarium.operators import closure, hierarchy, sequences, structure
from lexicarium.sources import graph_store, json_arrays, published
from lexicarium.streaming import ledger


# --- hierarchies ---------------------------------------------------------------------------------
def plain_depths(nodes, edges):
    """({node: (depth, on_cycle)}, cut edges): components by Tarjan, the stated rule, then a plain depth-first search for the longest path."""
    below = collections.defaultdict(list)
    for p, c in edges:
        below[p].append(c)
    every = set(nodes) | {x for e in edges for x in e}
    index, low, stack, on, component = {}, {}, [], set(), {}

    def tarjan(v):
        index[v] = low[v] = len(index)
        stack.append(v)
        on.add(v)
        for w in below[v]:
            if w not in index:
                tarjan(w)
                low[v] = min(low[v], low[w])
            elif w in on:
                low[v] = min(low[v], index[w])
        if low[v] == index[v]:
            members = []
            while True:
                w = stack.pop()
                on.discard(w)
                members.append(w)
                if w == v:
                    break
            for w in members:
                component[w] = (v, len(members))

    for v in sorted(every):
        if v not in index:
            tarjan(v)
    cut = {(p, c) for p, c in edges if component[p] == component[c] and component[p][1] > 1 and c <= p}
    above = collections.defaultdict(list)
    for p, c in set(edges) - cut:
        above[c].append(p)
    known = {}

    def depth(v):
        if v not in known:
            known[v] = max((depth(p) + 1 for p in above[v]), default=0)
        return known[v]

    return {v: (depth(v), component[v][1] > 1) for v in every}, cut


def test_depths_equal_a_plain_search_on_random_graphs(spark):
    rng = random.Random(1)
    nodes, edges = [], []
    for g in range(25):  # graphs side by side: cycles, diamonds, dangling ends, two-node circles, chains
        n = rng.randint(1, 9)
        names = [f"{g:02d}-{rng.randrange(1000)}-{k}" for k in range(n)]
        nodes += names[: rng.randint(0, n)]
        edges += [(a, b) for a in names for b in names if a != b and rng.random() < rng.choice([0.1, 0.2, 0.4])]
        edges += list(zip(names, names[1:], strict=False)) if g % 3 == 0 else []
    expected, cut = plain_depths(nodes, edges)
    e = spark.createDataFrame([*edges, ("self", "self")], "parent string, child string")
    found, cut_found = hierarchy.hierarchy_depths(spark.createDataFrame([(n,) for n in nodes], "node string"), e)
    assert {r.node: (r.depth, r.on_cycle) for r in found.collect()} == expected and found.count() == len(expected)
    assert {tuple(r) for r in cut_found.collect()} == cut and cut


def test_hierarchy_without_cycles_and_without_edges(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "d"), ("a", "c"), ("c", "d"), ("a", "d"), ("d", "e")], "parent string, child string")
    found, cut = hierarchy.hierarchy_depths(spark.createDataFrame([("a",), ("alone",)], "node string"), e)
    assert {r.node: (r.depth, r.on_cycle) for r in found.collect()} == {"a": (0, False), "b": (1, False), "c": (1, False), "d": (2, False), "e": (3, False), "alone": (0, False)}
    assert cut.count() == 0
    none, _ = hierarchy.hierarchy_depths(spark.createDataFrame([("x",)], "node string"), e.limit(0))
    assert [tuple(r) for r in none.collect()] == [("x", 0, False)]


def test_pruned_hierarchy(spark):
    e = spark.createDataFrame([("a", "b", 3), ("a", "b", 5), ("a", "c", 5), ("a", "d", 1), ("a", "a", 9), ("b", "x", 7), (None, "a", 2), ("b", "c", None)], "parent string, child string, weight long")
    reg = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",)], "node string")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(hierarchy.pruned_hierarchy(e, reg)) == [("a", "b", 5), ("a", "c", 5), ("a", "d", 1), ("b", "c", 1)]
    assert rows(hierarchy.pruned_hierarchy(e, reg, least=2, per_parent=1)) == [("a", "b", 5)]
    assert rows(hierarchy.pruned_hierarchy(e, None, most=2)) == [("a", "b", 5), ("b", "x", 7)]
    kept = hierarchy.pruned_hierarchy(e, reg)
    report = hierarchy.hierarchy_report(e, reg, kept, *hierarchy.hierarchy_depths(reg, kept)).first()
    assert (report.rows_read, report.rows_used, report.rows_dropped, report.edges_kept, report.max_depth, report.cycle_detected) == (8, 6, 2, 4, 2, False)


# --- batches -------------------------------------------------------------------------------------
def plain_batches(sizes, budget):
    out, batch, used = [], -1, None
    for size in sizes:
        if used is None or used + size + 1 > budget:
            batch, used = batch + 1, 2
        out.append(batch)
        used += size + 1
    return out


@pytest.mark.parametrize(("budget", "block"), [(20, 7), (100, 65_536), (1, 3)])
def test_greedy_batches_equal_a_plain_loop(spark, budget, block):
    rng = random.Random(budget)
    rows, expected = [], []
    for key in [*[f"k{k}" for k in range(8)], None]:
        sizes = [rng.choice([0, 1, rng.randrange(30), rng.randrange(300)]) for _ in range(rng.choice([0, 1, 2, 60]))]
        at, place = 0, []
        for _ in sizes:  # places need not be dense
            place.append(at)
            at += rng.choice([1, 1, 5])
        rows += list(zip([key] * len(sizes), place, ["x" * s for s in sizes], strict=True))
        expected += list(zip([key] * len(sizes), place, plain_batches(sizes, budget), strict=True))
    df = spark.createDataFrame(rows, "key string, at long, text string").withColumn("i", F.lit("clash")).withColumn("batch", F.lit(-1)).repartition(5)
    found = sequences.greedy_batches(df, ["key"], "at", F.octet_length("text"), budget, block=block)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_batches_without_a_key_and_manifest_and_reconstruction(spark):
    texts = ['{"a":1}', '"é"', "[]", '"' + "y" * 50 + '"', "1", "2"]
    df = spark.createDataFrame(list(enumerate(texts)), "at long, text string")
    batches = sequences.greedy_batches(df, [], "at", F.octet_length("text"), 24)
    assert [r.batch for r in batches.orderBy("at").collect()] == plain_batches([len(t.encode()) for t in texts], 24)
    both = df.join(batches, "at")
    arrays = collections.defaultdict(list)
    for r in both.orderBy("at").collect():
        arrays[r.batch].append(r.text)
    manifest = {r.batch: (r.items, r.bytes, r.sha256) for r in sequences.batch_manifest(both, [], "at", F.col("text")).collect()}
    whole = {b: ("[" + ",".join(t) + "]").encode() for b, t in arrays.items()}
    assert manifest == {b: (len(arrays[b]), len(w), hashlib.sha256(w).hexdigest()) for b, w in whole.items()}
    assert [x for b in sorted(whole) for x in json.loads(whole[b])] == [json.loads(t) for t in texts]
    keyed = both.withColumn("key", F.lit("k"))
    check = lambda rows: sequences.reconstruction(keyed, rows, ["key"], "at", "text").first()
    assert check(keyed.repartition(3)).complete
    assert not check(keyed.where("at <> 4")).complete and check(keyed.where("at <> 4")).found == 5
    swapped = keyed.withColumn("at", F.when(F.col("at") == 4, 5).when(F.col("at") == 5, 4).otherwise(F.col("at")))
    assert not check(swapped).complete  # same contents at other places


def test_concurrency_equals_a_plain_sweep(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), s, s + rng.choice([0, 1, 5, 40, -3])) for s in (rng.randrange(100) for _ in range(80))] + [("a", 5, None), ("c", 1, 1)]
    expected = []
    for key in {r[0] for r in rows}:
        own = [(s, e) for k, s, e in rows if k == key and e is not None and s < e]
        expected += [(key, at, sum(s <= at < e for s, e in own)) for at in {x for pair in own for x in pair}]
    found = sequences.concurrency(spark.createDataFrame(rows, "key string, s long, e long"), ["key"], "s", "e", block=7)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


# --- structure statistics ------------------------------------------------------------------------
def test_structure_statistics_and_gate(spark):
    uuid_key = "123e4567-e89b-42d3-a456-426614174000"
    values = [{"a": 1, "b": [1, "x", {"c": None}], uuid_key: {"d": True}}, {"a": "s", "b": []}, [], 3, {"a": {"zz": 1}}]
    rows = [(json.dumps(v),) for v in values] + [(None,), ("{bad",), ("[" * 70 + "]" * 70,)]
    stats = structure.structure_statistics(spark.createDataFrame(rows, "j string").withColumn("path", F.lit("clash")).repartition(3), "j")
    got = {(r.path, r.type): r for r in stats.collect()}
    assert (got["", "object"].seen, got["", "object"].size_min, got["", "object"].size_max, got["", "object"].size_avg) == (3, 1, 3, 2.0)
    assert got["", "object"].child_types == {"number": 1, "array": 2, "object": 2, "string": 1} and got["", "object"]["keys"] == ["**", "a", "b"]
    assert got["/b", "array"].child_types == {"number": 1, "string": 1, "object": 1} and got["/b", "array"].size_avg == 1.5
    assert got["/**/d", "boolean"].seen == 1 and got["/b/*/c", "null"].child_types is None and got["", "invalid"].seen == 1
    assert got["/*" * 69, "array"].seen == 1  # any depth
    contract = [("", ["object"], True), ("/a", ["number"], True), ("/b", ["array"], True), ("/b/*", ["number", "string"], False), ("/e", ["string"], True)]
    problems = {(r.path, r.type, r.problem): r.n for r in structure.structure_gate(stats.where(~F.col("path").rlike(r"^/\*(/|$)") & (F.col("type") != "invalid")), contract).collect()}
    assert problems == {("", "array", "unexpected_type"): 2, ("", "number", "unexpected_type"): 1, ("/a", "string", "unexpected_type"): 1, ("/a", "object", "unexpected_type"): 1, ("/b/*", "object", "unexpected_type"): 1, ("/**", "object", "unknown_field"): 1,
                        ("/**/d", "boolean", "unknown_field"): 1, ("/b/*/c", "null", "unknown_field"): 1, ("/a/zz", "number", "unknown_field"): 1, ("/b", None, "missing"): 1, ("/e", None, "missing"): 3}
    ext = spark.createDataFrame([('{"a": 1, "x": {"y": [1]}, "z": "t"}',), ("{}",), ("[1]",), (None,)], "j string").select(structure.extensions(F.col("j"), ["a"]).alias("e"))
    assert [r.e for r in ext.collect()] == [{"x": '{"y":[1]}', "z": "t"}, {}, None, None]


# --- array files ---------------------------------------------------------------------------------
def chunked(data, size, field=None, unique=False):
    """What the two passes do, without Spark."""
    edges = list(range(0, max(1, len(data)), size))
    inside, depth, begun, states = False, 0, False, []
    for start in edges:
        quotes, outside, within, blank = json_arrays.summed_up(io.BytesIO(data), start, min(len(data), start + size))
        states.append((start, min(len(data), start + size), inside, depth, begun))
        depth += within if inside else outside
        inside ^= bool(quotes % 2)
        begun = begun or not blank
    if depth or inside or not begun:
        raise json_arrays.JsonArrayError("not closed")
    keys = []
    if field is not None:
        keys = [k for s in states for k in json_arrays.root_keys_of(io.BytesIO(data), *s[:4])]
        assert [k for _, k in keys].count(field) == 1
    out = []
    for s in states:
        before = [name for at, name in keys if at < s[0]]
        out += json_arrays.items_of(io.BytesIO(data), "file", *s, field, before[-1] if before else None, unique)
    return [text for _, text in out]


TRICKY = [{"a": '],[{"\\', "b": [1, [2, {"c": "\\\""}]], "é": "\n"}, [], "plain, \"quoted\"", 1, None, {"x": {}}, "", "\\\\", [[["}"]]], {"k": "日本" * 20}]


def test_arrays_are_read_the_same_whatever_the_chunks():
    for indent in (None, 2):
        for bom in (b"", b"\xef\xbb\xbf"):
            data = bom + b" \n" + json.dumps(TRICKY, indent=indent, ensure_ascii=False).encode() + b"\n "
            for size in [*range(4 if bom else 1, 40), 100, 10_000]:  # a byte order mark lies in one chunk
                assert [json.loads(t) for t in chunked(data, size)] == TRICKY, size
    for size in (1, 2, 5):
        assert chunked(b" [ ] ", size) == []


def test_object_arrays_are_read_the_same_whatever_the_chunks():
    root = {"meta": {"items": [1, 2]}, "list": [[3], "items"], "items": TRICKY, "tail": "x", "last": [4]}
    data = json.dumps(root, indent=1).encode()
    for size in [*range(1, 40), 100, 10_000]:
        assert [json.loads(t) for t in chunked(data, size, "items")] == TRICKY, size


@pytest.mark.parametrize("data", [b"", b"  ", b"{}", b"[1,2] x", b"[1,2][3]", b"[1,2", b"[1,,2]", b"[1,]", b"[tru]", b'[1,"a]', b"1", b"[1]]", b'"[1]"', b"[1 2]", b"x[1]"])
def test_broken_arrays_are_errors(data):
    for size in (1, 2, 3, 50):
        with pytest.raises(ValueError):
            chunked(data, size)


def test_fields_that_stand_twice(spark, tmp_path):
    data = b'[{"a": 1, "b": {"a": 2}}, {"a": 1, "a": 2}]'
    assert json.loads(chunked(data, 9)[1]) == {"a": 2}
    with pytest.raises(json_arrays.JsonArrayError, match="stands twice"):
        chunked(data, 9, unique=True)
    for text, message in (('{"items": [1], "items": [2]}', "duplicate root field"), ('{"other": [1]}', "missing array field")):
        path = tmp_path / "o.json"
        path.write_text(text)
        with pytest.raises(json_arrays.JsonArrayError, match=message):
            json_arrays.object_array(spark, str(path), "items", 4)
    with pytest.raises(json_arrays.JsonArrayError):
        chunked(b'{"items": {"a": [1]}}', 5, "items")


def test_array_files_in_spark(spark, tmp_path):
    rows = [(k, f'text "{k}" [,] \\ ' * (k % 5)) for k in range(300)] + [(None, None)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    json_arrays.write_arrays(docs, str(tmp_path / "arrays"))
    items = json_arrays.root_array(spark, str(tmp_path / "arrays"), chunk_bytes=500, unique_fields=True).cache()
    got = items.select(F.from_json("json", "id long, text string").alias("r")).select("r.*").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)
    numbers = collections.defaultdict(list)
    for r in json_arrays.numbered(items, 500).collect():
        numbers[r.path].append((r.offset, r["index"]))
    assert all([i for _, i in sorted(v)] == list(range(len(v))) for v in numbers.values())
    assert sum(r["items"] for r in json_arrays.inspected(items).collect()) == 301
    (tmp_path / "o.json").write_text(json.dumps({"n": 1, "items": TRICKY, "z": []}))
    got = json_arrays.object_array(spark, str(tmp_path / "o.json"), "items", 16).orderBy("offset").collect()
    assert [json.loads(r.json) for r in got] == TRICKY
    assert [r.key for r in json_arrays.root_fields(spark, str(tmp_path / "o.json"), 16).orderBy("offset").collect()] == ["n", "items", "z"]
    (tmp_path / "bad.json").write_text("[1,2] 3")
    with pytest.raises(Exception, match="trailing"):
        json_arrays.root_array(spark, str(tmp_path / "bad.json"), 4).collect()


# --- closures ------------------------------------------------------------------------------------
def test_closure_equals_a_plain_search(spark):
    rng = random.Random(3)
    ids = [(rng.choice("ab"), str(k)) for k in range(40)]
    refs = [(*rng.choice(ids), "R", *rng.choice([*ids, ("a", "lost")])) for _ in range(50)] + [("a", None, "R", "b", "1"), ("a", "1", "R", "b", None)]
    selected = [ids[0], ids[0], ids[7], ("a", "never")]
    expected, frontier, hops = {}, set(selected), 0
    while frontier:
        expected |= {x: hops for x in frontier}
        frontier = {(r[3], r[4]) for r in refs if (r[0], r[1]) in frontier and r[1] and r[4]} - set(expected)
        hops += 1
    pair = "kind string, id string"
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    references, objects = make(refs, "kind string, id string, relation string, to_kind string, to_id string"), make(ids, pair)
    found = closure.closure(make([*selected, ("a", None)], pair), references, objects)
    assert sorted(map(tuple, found.collect())) == sorted((*k, h, k not in set(ids)) for k, h in expected.items())
    with pytest.raises(closure.MissingObject):
        closure.closure(make(selected, pair), references, objects, "reject")
    assert closure.closure(make([ids[3]], pair), references.limit(0), objects, "reject").count() == 1
    assert closure.closure(make([], pair), references, objects, "reject").count() == 0
    bodies = objects.withColumn("body", F.concat("kind", "id"))
    records = closure.replay_records(found, bodies, references)
    manifest = closure.replay_manifest(records, found).first()
    inner = {r for r in refs if (r[0], r[1]) in expected and (r[3], r[4]) in expected}
    assert (manifest.objects, manifest.relations, manifest.missing) == (len(expected), len(inner), sum(k not in set(ids) for k in expected))
    assert closure.replay_manifest(records.repartition(7), found).first().content_hash == manifest.content_hash
    assert closure.replay_manifest(records.where("id <> '0'"), found).first().content_hash != manifest.content_hash


def test_selection_of_assets(spark):
    instances = spark.createDataFrame([("i1", "c1", "x"), ("i2", "c1", "y"), ("i3", "c2", "y")], "instance_id string, concept_id string, asset_id string")
    attributes = spark.createDataFrame([("a1", "concept", "c1"), ("a2", "instance", "i3"), ("a3", "concept", "c2")], "attr_id string, object_type string, object_id string")
    found = closure.selection_of_assets(instances, attributes, spark.createDataFrame([("x",)], "asset_id string"))
    assert sorted(map(tuple, found.collect())) == [("attribute", "a1"), ("concept", "c1"), ("instance", "i1")]


# --- published tables ----------------------------------------------------------------------------
def customers(spark, ids, value):
    return spark.createDataFrame([(i, value) for i in ids], "id long, v string")


def test_published_versions_and_merges(spark, tmp_path):
    t = published.PublishedTable(spark, str(tmp_path / "t"), ["id"], buckets=4)
    with pytest.raises(ValueError):
        t.read()
    t.replace(customers(spark, range(20), "old"))
    before = t.manifest()
    m = t.merge(customers(spark, [3, 100], "new"))
    assert m["version"] == 2 and m["rows"] == 21 and m["written"] <= 2
    untouched = {k for k, b in m["buckets"].items() if b == before["buckets"].get(k)}
    assert len(untouched) >= 2  # their folders are carried over, not rewritten
    assert {r.id: r.v for r in t.read().collect()} == {i: "new" if i in (3, 100) else "old" for i in [*range(20), 100]}
    assert {r.v for r in t.read(1).collect()} == {"old"} and t.versions() == [1, 2]
    assert t.merge(customers(spark, [], "x"))["version"] == 2
    assert t.expire() == 1 and t.versions() == [2] and t.read().count() == 21


def test_a_killed_writer_leaves_the_last_version(spark, tmp_path):
    t = published.PublishedTable(spark, str(tmp_path / "t"), ["id"], buckets=2)
    t.replace(customers(spark, [1, 2], "a"))
    rows = customers(spark, [1], "half").withColumn("bucket_", F.lit(0))
    rows.write.partitionBy("bucket_").parquet(str(tmp_path / "t" / "data-dead"))  # data of a writer that died before its commit
    (tmp_path / "t" / "_versions" / ".draft").write_text('{"version": 2')  # and one that died while it wrote the version
    (tmp_path / "t" / "_claims" / "000000000002").touch()  # and one that died between claim and rename
    assert {r.v for r in t.read().collect()} == {"a"}
    with pytest.raises(published.VersionTaken):
        t._publish(lambda base: (customers(spark, [1], "b"), [0, 1]), tries=2)
    t.claim_seconds = -10.0
    t.merge(customers(spark, [1], "b"))
    assert {(r.id, r.v) for r in t.read().collect()} == {(1, "b"), (2, "a")}


def test_two_writers_lose_nothing(spark, tmp_path):
    tables = [published.PublishedTable(spark, str(tmp_path / "t"), ["id"], buckets=2) for _ in range(2)]
    tables[0].replace(customers(spark, [0], "base"))
    threads = [threading.Thread(target=lambda t=t, k=k: t.merge(customers(spark, [10 + k], f"w{k}"))) for k, t in enumerate(tables)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r.v for r in tables[0].read().collect()) == ["base", "w0", "w1"] and tables[0].versions() == [1, 2, 3]


def test_export_is_capped(spark, tmp_path):
    counts = published.export_rows(customers(spark, range(10), "x"), str(tmp_path / "e"), ["id"], most=4).first()
    assert (counts.rows, counts.written, counts.truncated) == (10, 4, True)
    assert sorted(r.id for r in spark.read.json(str(tmp_path / "e")).collect()) == [0, 1, 2, 3]


# --- graph store ---------------------------------------------------------------------------------
def test_graph_merges_are_idempotent_and_verified(spark, tmp_path):
    s = graph_store.GraphStore(spark, str(tmp_path / "g"), buckets=4)
    nodes = lambda names, n: spark.createDataFrame([("U", x, str(n)) for x in names], "kind string, node_id string, properties string")
    edges = lambda rows: spark.createDataFrame(rows, "kind string, src string, dst string, weight long")
    s.merge_nodes(nodes(["a", "b", "c", "c"], 1), "s1")
    first = edges([("ADJACENT_TO", "a", "b", 1), ("ADJACENT_TO", "a", "b", 3), ("CO_OCCURS_WITH", "c", "a", 2), ("ADJACENT_TO", "a", "zz", 1), ("ADJACENT_TO", None, "b", 1)])
    m = s.merge_edges(first, "s1", "U", "U")
    assert (m["matched"], m["unmatched"]) == (2, 1)
    s.merge_nodes(nodes(["b", "d"], 2), "s2")
    for _ in range(2):  # a replay changes nothing
        s.merge_edges(edges([("ADJACENT_TO", "a", "b", 9), ("ADJACENT_TO", "b", "d", 1)]), "s2", "U", "U")
        got = sorted(tuple(r) for r in s.edges.read().select("kind", "src", "dst", "weight", "created_in", "synced_in").collect())
        assert got == [("ADJACENT_TO", "a", "b", 9, "s1", "s2"), ("ADJACENT_TO", "b", "d", 1, "s2", "s2"), ("CO_OCCURS_WITH", "a", "c", 2, "s1", "s1")]
    assert sorted(tuple(r) for r in s.nodes.read().select("node_id", "properties", "created_in", "synced_in").collect()) == [("a", "1", "s1", "s1"), ("b", "2", "s1", "s2"), ("c", "1", "s1", "s1"), ("d", "2", "s2", "s2")]
    assert s.verified()
    assert {(r.table, r.kind): r.n for r in s.counts().collect()} == {("nodes", "U"): 4, ("edges", "ADJACENT_TO"): 2, ("edges", "CO_OCCURS_WITH"): 1}
    s.nodes.replace(nodes(["a"], 1).withColumn("synced_in", F.lit("x")).withColumn("created_in", F.lit("x")))
    assert not s.verified()  # edges without their ends


def test_hierarchy_projection_sets(spark):
    rows = [
        ("as", "c1", "T", "n1", None, "user", 0, False, "/m/message/content/parts/0", " hi "),
        ("as", "c1", "T", "n1", None, "user", 0, False, "/m/message/content/parts/1", "hi"),
        ("as", "c1", None, "n2", "n1", "tool", 1, True, "/m/metadata", "hi"),
        ("as", "c1", "T", "n2", "n1", "tool", 1, True, "/m/message/content/parts/0", "rare"),
        ("as", "c1", "T", None, None, None, None, None, "/title", "T"),
    ]
    df = spark.createDataFrame(rows, "asset_id string, conversation_id string, title string, node_id string, parent_id string, role string, depth long, is_leaf boolean, path string, unit_text string")
    assert sorted((r.kind, r.node_id) for r in graph_store.hierarchy_nodes(df).collect()) == [("Conversation", "c1"), ("MappingNode", "as::n1"), ("MappingNode", "as::n2")]
    edges = lambda reg: sorted((r.kind, r.src, r.dst) for r in graph_store.hierarchy_edges(df, reg).collect())
    base = [("CONTAINS_UNIT", "as::n1", "hi"), ("HAS_NODE", "c1", "as::n1"), ("HAS_NODE", "c1", "as::n2"), ("PARENT_OF", "as::n1", "as::n2")]
    assert edges(spark.createDataFrame([("hi ",)], "unit_text string")) == base
    assert edges(None) == sorted([*base, ("CONTAINS_UNIT", "as::n2", "rare")])


# --- append ledger -------------------------------------------------------------------------------
def requests(n, seed):
    rng = random.Random(seed)
    rows, heads = [], collections.Counter()
    for k in range(n):
        anchor = rng.choice(["p", "q", "r"])
        base = rng.choice([heads[anchor], heads[anchor], heads[anchor] - 1, 0])
        heads[anchor] += base == heads[anchor]
        again = rng.randrange(k + 1) if rng.random() < 0.3 else k
        rows.append((anchor, rng.choice("xy"), f"req{again}", base if base > 0 else rng.choice([0, None]), f"ann{rng.choice([k, k, max(0, k - 5)])}", rng.choice(["note", "result"]), f"ann{rng.randrange(k + 1)}" if rng.random() < 0.4 else None, rng.choice(["h1", "h2"]), f"2024-01-01 00:{k // 60:02d}:{k % 60:02d}"))
    return rows


def folded(rows):
    """A plain fold of the whole log."""
    out, state = [], collections.defaultdict(lambda: {"head": 0, "receipts": {}, "kinds": {}, "branches": collections.Counter()})
    for anchor, producer, request, base, annotation, kind, target, content, _ in rows:
        s = state[anchor]
        held = s["receipts"].get((producer, request))
        outcome, revision, branches = None, None, None
        if held:
            outcome, revision = ("existing", held[1]) if held[0] == content else ("idempotency_conflict", None)
        elif annotation in s["kinds"]:
            outcome = "annotation_conflict"
        elif (base or 0) != s["head"]:
            outcome = "revision_conflict"
        elif target is not None and s["kinds"].get(target) != kind:
            outcome = "supersession_invalid"
        else:
            s["head"] += 1
            outcome, revision = "persisted", s["head"]
            s["receipts"][(producer, request)] = (content, revision)
            s["kinds"][annotation] = kind
            if target is not None:
                s["branches"][target] += 1
                branches = s["branches"][target]
        out.append((anchor, producer, request, annotation, outcome, revision, branches))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cuts", [[], [1, 2, 40], [30, 60]])
def test_ledger_equals_a_plain_fold_at_every_split_and_after_a_restart(spark, tmp_path, cuts):
    rows = requests(90, 7)
    schema = "anchor_id string, producer_id string, request_id string, base_revision long, annotation_id string, annotation_type string, supersedes string, content_hash string, request_at string"
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):  # each part is a start of the query anew
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(source)
        ledger.append(ledger.folder_stream(spark, source, schema), out, state).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(map(tuple, got.collect()), key=repr) == folded(rows)
    assert {r.outcome for r in ledger.append_counts(got).collect()} >= {"persisted", "existing", "idempotency_conflict", "revision_conflict", "supersession_invalid", "annotation_conflict"}


def test_requests_without_an_anchor_are_invalid(spark):
    rows = [(None, "p", "r", None, "a", "note", None, "h", None), ("x", "p", None, None, "a", "note", None, "h", None), ("x", "p", "r", None, "a", "note", None, "h", None)]
    df = spark.createDataFrame(rows, "anchor_id string, producer_id string, request_id string, base_revision long, annotation_id string, annotation_type string, supersedes string, content_hash string, request_at string")
    assert [r.outcome for r in ledger.invalid(df).collect()] == ["invalid", "invalid"]
