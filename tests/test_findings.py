"""What findings asked of single queries: how often a plan does its costly steps, and that results stay whole."""

import __spark_entry__
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- F9 ------------------------------------------------------------------------------------------
def test_topology_reads_split_units_and_counts_null_and_repeated_ids(spark):
    from lexicarium.operators import audits

    found = __spark_entry__.queries()["payload_topology"](spark, SMALL)
    assert "MapInArrow" not in _plan(found)  # split once, into a table
    concepts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "concept_id string")
    instances = spark.createDataFrame([("1", "a"), ("1", "c"), ("2", None), ("3", "c")], "instance_id string, concept_id string")
    attributes = spark.createDataFrame([("x", "concept", "a", "k", "1"), ("y", "concept", "a", "k", "2"), ("y", "concept", "d", "k", "1"), ("z", "other", "e", "k", None), ("z", "concept", None, "k", "1")], "attr_id string, object_type string, object_id string, attr_key string, attr_value string")
    got = {r.check_name: r.violations for r in audits.topology(concepts, instances, attributes).collect()}
    assert got == {"instance_without_concept": 3, "attribute_without_object": 2, "repeated_concept": 1, "repeated_instance": 1, "repeated_attribute": 2, "attribute_conflict": 1}
    empty = audits.topology(concepts.limit(0), instances.limit(0), attributes.limit(0)).collect()
    assert [r.violations for r in empty] == [0] * 6


# --- F10 -----------------------------------------------------------------------------------------
class _State:
    """A value or map state that counts what it is asked."""

    def __init__(self):
        self.held, self.reads, self.writes = {}, 0, 0

    def get(self):
        return self.held.get(())

    def update(self, value):
        self.held[()] = value

    def containsKey(self, key):
        self.reads += 1
        return key in self.held

    def getValue(self, key):
        self.reads += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self.held[key] = value


class _Handle:
    def __init__(self):
        self.states = {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, _State())

    def getMapState(self, name, *schemas):
        return self.states.setdefault(name, _State())


def test_a_new_anchor_asks_the_store_nothing_and_a_known_one_once_a_key():
    from pyspark.sql import Row

    from lexicarium.streaming import ledger

    request = lambda k, base, supersedes=None, producer="p": Row(anchor_id="a", producer_id=producer, request_id=f"r{k}", base_revision=base, annotation_id=f"n{k}", annotation_type="note", supersedes=supersedes, content_hash="h", request_at=k)
    handle, processor = _Handle(), ledger.AppendLedger()
    processor.init(handle)
    asked = lambda: sum(s.reads for s in handle.states.values())
    first = [request(2, 2, "n0"), request(1, 1, "n0"), request(0, None)]
    got = [(r.outcome, r.revision, r.branches) for r in processor.handleInputRows(("a",), iter(first), None)]
    assert got == [("persisted", 1, None), ("persisted", 2, 1), ("persisted", 3, 2)]
    assert asked() == 0 and handle.states["branches"].writes == 1  # its last count only
    again = [request(1, 1, "n0"), request(1, 1, "n0"), request(1, 3, None, "q"), request(3, 3, "n0")]
    got = [(r.outcome, r.revision, r.branches) for r in processor.handleInputRows(("a",), iter(again), None)]
    assert got == [("existing", 2, None), ("existing", 2, None), ("annotation_conflict", None, None), ("persisted", 4, 3)]
    assert asked() == 7  # receipts of p r1, q r1, p r3; kinds of n1, n3, n0; branches of n0


# --- F12 -----------------------------------------------------------------------------------------
def test_edges_between_short_keys_get_the_registered_names(spark):
    from lexicarium.operators import graphs

    edges = spark.createDataFrame([("a", "b", 2), ("b", "a", 1), ("a", "x", 5), ("x", "b", 7)], "src string, dst string, weight long")
    keyed = edges.select(graphs.short_key("src").alias("src"), graphs.short_key("dst").alias("dst"), "weight")
    register = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "node string")
    got = graphs.named_edges(keyed, register)
    assert sorted(map(tuple, got.collect())) == [("a", "b", 2), ("b", "a", 1)] and got.columns == ["src", "dst", "weight"]


def test_graph_merge_groups_no_texts_but_those_of_its_edges(spark):
    from lexicarium.operators import graphs

    grouped, real = [], graphs.adjacency_edges
    graphs.adjacency_edges = lambda units: grouped.append(dict(units.dtypes)["unit_text"]) or real(units)
    try:
        assert __spark_entry__.queries()["graph_merge"](spark, SMALL).count() > 0
    finally:
        graphs.adjacency_edges = real
    assert grouped == ["binary", "binary"]


# --- F16 -----------------------------------------------------------------------------------------
def test_array_files_are_written_from_arrow_slices(spark, tmp_path, monkeypatch):
    import glob
    import json

    from lexicarium.sources import json_arrays

    rows = spark.range(1000).select("id", F.concat(F.lit('é"\n,]['), F.col("id").cast("string")).alias("t")).repartition(3)
    with monkeypatch.context() as m:
        m.setattr(type(rows), "mapInPandas", None)  # a batch as Python strings is several times its bytes
        json_arrays.write_arrays(rows, str(tmp_path / "a"))
        json_arrays.write_arrays(spark.range(0, 3, 1, 1).where("id < 0"), str(tmp_path / "none"))
    read = lambda d: [json.load(open(f, encoding="utf-8")) for f in glob.glob(f"{tmp_path}/{d}/part-*")]
    assert sorted((x["id"], x["t"]) for part in read("a") for x in part) == [(k, f'é"\n,][{k}') for k in range(1000)]
    assert all(part == [] for part in read("none"))
    assert json_arrays.root_array(spark, str(tmp_path / "a"), 700, True).count() == 1000


# --- F15 -----------------------------------------------------------------------------------------
def test_json_values_are_parsed_once_for_nodes_and_report(spark):
    from lexicarium.operators import structure

    docs = [(1, '{"m": {"123e4567-e89b-12d3-a456-426614174000": {"a": 1}, "x": {}}, "l": [[], [1, [2]]]}'), (2, '{"m": {"b": null}, "n": 1.5}'), (3, "{bad"), (4, "7"), (5, '{"m": {"b": "t"}}'), (6, '{"l": [[], []]}')]
    report = structure.structure_report(structure.json_nodes(spark.createDataFrame(docs, "id long, j string"), "id", "j"))
    assert _plan(report).lower().count("parse_json") <= 2  # the plan's one projection and its filter; a parse a level and branch before
    got = {(r.path, r.type): (r.seen, r.size_min, r.size_max, r.size_avg, r["keys"]) for r in report.collect()}
    none = (None, None, None, None)
    assert got == {
        ("", "object"): (4, 1, 2, 1.5, ["l", "m", "n"]), ("", "number"): (1, *none), ("/m", "object"): (3, 1, 2, 1.333, ["**", "b", "x"]), ("/m/**", "object"): (1, 1, 1, 1.0, ["a"]),
        ("/m/**/a", "number"): (1, *none), ("/m/x", "object"): (1, 0, 0, 0.0, None), ("/m/b", "null"): (1, *none), ("/m/b", "string"): (1, *none), ("/n", "number"): (1, *none),
        ("/l", "array"): (2, 2, 2, 2.0, None), ("/l/*", "array"): (4, 0, 2, 0.5, None), ("/l/*/*", "number"): (1, *none), ("/l/*/*", "array"): (1, 1, 1, 1.0, None), ("/l/*/*/*", "number"): (1, *none),
    }


# --- F18 -----------------------------------------------------------------------------------------
def _drawn_lines(seed):
    """Lines of texts of their own, of frequent and of null texts, with copies and near copies, as (texts, times)."""
    import random

    draw = random.Random(seed)
    text = lambda: draw.choice([f"own {draw.random()}", f"own {draw.random()}", f"word {draw.randrange(4)}", f"é {draw.randrange(30)}", "", None])
    lines = [[text() for _ in range(draw.choice([1, 2, 3, 5, 9, 30]))] for _ in range(120)]
    lines += [draw.choice(lines) for _ in range(40)] + [[*draw.choice(lines), text()] for _ in range(40)] + [["a\nb", "c", "d"], ["a", "b", "c", "d"], ["t"] * 20, ["x", "y"] * 20]
    return [(u, draw.choice([1, 1, 3])) for u in lines]


def _paired(lines):
    from collections import Counter

    found = Counter()
    for u, n in lines:
        for i, a in enumerate(u):
            for b in u[i + 1 :]:
                if a is not None and b is not None and a != b:
                    found[a, b] += n
    return found


def test_edges_of_lines_are_all_pairs_each_once(spark):
    from lexicarium.operators import graphs

    for seed, size in ((1, 500), (2, 3)):
        lines = _drawn_lines(seed)
        got = graphs.line_edges(spark.createDataFrame(lines, "u array<string>, n long").repartition(3), size)
        rows = got.collect()
        assert {(r.src, r.dst): r.weight for r in rows} == _paired(lines) and len(rows) == len(_paired(lines))
        assert got.dtypes == [("src", "string"), ("dst", "string"), ("weight", "bigint")]
    assert graphs.line_edges(spark.createDataFrame([], "u array<string>, n long")).count() == 0


def test_pairs_of_a_batch_do_not_depend_on_its_blocks(monkeypatch):
    import pyarrow as pa

    from lexicarium.operators import graphs

    once = {}
    for u, n in _drawn_lines(3):
        once[tuple(u)] = once.get(tuple(u), 0) + n
    held = [t for u in once for t in set(u)]
    marks = [[hash(t) for t in set(u) if held.count(t) > 1] or None for u in once]
    batch = pa.record_batch([pa.array(map(list, once), pa.list_(pa.string())), pa.array([list(map(hash, u)) for u in once], pa.list_(pa.int64())), pa.array(marks, pa.list_(pa.int64())), pa.array(once.values(), pa.int64())], ["u", "h", "marks", "n"])
    want, several = _paired(once.items()), {t for t in held if held.count(t) > 1}
    for block, size in ((1, 1), (1, 500), (7, 4), (60, 500), (200_000, 500), (200_000, 2)):
        monkeypatch.setattr(graphs, "PAIRS", block)
        own, shared = ([r for b in graphs._line_pairs([batch, batch.slice(0, 0)], size, s) for r in zip(*b.to_pydict().values())] for s in (False, True))
        assert {(a, b): w for a, b, w in own} == {k: w for k, w in want.items() if not several.issuperset(k)} and len({r[:2] for r in own}) == len(own)
        total = {}
        for a, b, w in shared:
            total[a, b] = total.get((a, b), 0) + w
        assert total == {k: w for k, w in want.items() if several.issuperset(k)}


def test_cooccurrence_shuffles_lines_once_and_only_pairs_of_texts_of_several_lines(spark):
    from lexicarium.operators import graphs, units
    from lexicarium.plans import queries

    found = __spark_entry__.queries()["cooccurrence_edges"](spark, SMALL)
    rows = sorted(map(tuple, found.collect()))
    final = _plan(found).split("Initial Plan")[0]
    assert "asset_id" not in final and final.count("MapInArrow cut(") == 1  # units were dealt out by container before
    assert "Union" in final.split("HashAggregate")[0]  # every pair was grouped before
    assert rows == sorted(map(tuple, graphs.cooccurrence_edges(queries._units(spark, SMALL)).collect()))
    values = spark.createDataFrame([("a. b. c.\nx\n\n a. b. c. \n。A。",), (None,), ("",), ("a. b. c.\n. .",)], "value string")
    got = {}
    for r in units.split_lines(values).collect():
        got[tuple(r.u)] = got.get(tuple(r.u), 0) + r.n
    assert got == {("a.", "b.", "c."): 3, ("。", "A。"): 1, (".", "."): 1}


# --- round 4, F1 ---------------------------------------------------------------------------------
def test_first_coordinate_compares_as_the_sql_does(spark):
    from lexicarium.operators import units

    rows = [("1", "a", 5, 0, "t", "u1"), ("10", "a", 0, 0, "t", "u2"), (None, "a", 0, 0, "t", "u0"), (None, "a", 0, 0, "n", "u3"), (None, "a", 0, 0, "n", "u4"), ("7", "b", 2, 1, "s", "u6"), ("7", "a", 2, 1, "s", "u5"), ("7", "a", 10, 0, "s", "u4")]
    found = units.frequent_units(spark.createDataFrame(rows, "asset_id string, path string, segment_index int, sentence_index int, unit_text string, unit_id string"))
    assert {r.unit_text: r.example_unit_id for r in found.collect()} == {"t": "u2", "n": None, "s": "u5"}  # "10" and segment 0 stand before "1" and segment 5


# --- round 4, F5 ---------------------------------------------------------------------------------
def test_entropy_by_block_uses_whole_texts_and_the_gate_its_window(spark):
    from lexicarium.operators import profiles

    text = "a" * 1024 + "é" * 5 + "b" * 1024 + "é" * 5 + "ü" * 10
    values = spark.createDataFrame([("x", "/p", 0, text)], "asset_id string, path string, value_index long, value string")
    assert {r.block: (r.n, r.entropy) for r in profiles.entropy_by_block(values).collect()} == {"basic_latin": (2048, 1.0), "latin_supplement": (20, 1.0)}
    gate = profiles.with_blocks(profiles.observations(values), values).first().blocks
    assert {b.block: b.entropy for b in gate} == {"basic_latin": 0.0, "latin_supplement": 1.0}
    assert "<= 1024" not in __spark_entry__.oracle_sql()["entropy_by_block"]


# --- round 4, F2 and F3 --------------------------------------------------------------------------
def _shared_containers(spark):
    """Documents of which some share id, source and language, or lack one, with texts that repeat within and across lines."""
    import random

    draw = random.Random(4)
    sentence = lambda: draw.choice(["The. ", "a b. ", "12 ", "?! ", "--. ", "é。", f"own {draw.random()}. "])
    text = lambda: "\n".join("".join(sentence() for _ in range(draw.choice([0, 1, 2, 5]))) for _ in range(draw.choice([1, 3, 8])))
    docs = [(draw.choice([1, 2, 3, None]), draw.choice(["s", "t", None]), draw.choice(["en", "de"]), draw.choice([text(), text(), None])) for _ in range(40)]
    docs += [(k, f"s{k % 4}", "en", text()) for k in range(10, 90)]
    return spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").repartition(3)


def test_decisions_equal_those_of_the_stages_one_by_one(spark, monkeypatch):
    from lexicarium.operators import units

    docs = _shared_containers(spark)
    for rows, names, batch, often in ((docs, 500_000, 20_000, 9), (docs, 0, 3, 2), (docs.where("doc_id >= 10"), 500_000, 9, 64), (docs.limit(0), 500_000, 3, 1)):
        for name, value in (("MOST_NAMES", names), ("BATCH", batch), ("OFTEN", often)):
            monkeypatch.setattr(units, name, value)
        values = units.values_of(rows)
        u = units.split_units(values)
        want = units.prominence(units.structure_profile(u), units.kept_boundaries(units.boundary_profile(u), units.noise_verdict(u)))
        got = units.value_decisions(values)
        assert got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_decisions_shuffle_texts_once(spark):
    plan = _plan(__spark_entry__.queries()["prominence"](spark, SMALL))
    assert plan.count("Exchange hashpartitioning(unit_text") == 2 and plan.count("Join") == 0  # all texts by themselves, and those met often by place; nine and three before
    register = _plan(__spark_entry__.queries()["structural_register"](spark, SMALL))
    assert register.count("Exchange hashpartitioning(unit_text") == 3 and register.count("Join") == 0  # the third holds the allowed texts


# --- round 4, F4 ---------------------------------------------------------------------------------
def test_pruned_pairs_equal_the_pruned_edges(spark):
    import random

    from lexicarium.operators import graphs

    draw = random.Random(8)
    node = lambda: draw.choice(["hub", "é", "z", f"n{draw.randrange(12)}", f"leaf {draw.random()}"])
    rows = [(a, b, draw.choice([1, 1, 2, 5])) for _ in range(600) if (a := node()) != (b := node())]
    pairs = spark.createDataFrame(rows, "src string, dst string, n long").repartition(3)
    for some in (pairs, pairs.where("src = 'hub'"), pairs.where("dst = 'hub'"), pairs.limit(0)):
        edges = some.groupBy("src", "dst").agg(F.sum("n").alias("weight"))
        for k in (1, 3, 1000):
            got, want = graphs.pruned_pairs(some, k), graphs.prune_edges(edges, per_node=k)
            assert got.dtypes == want.dtypes
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_adjacency_pairs_add_up_to_the_adjacency_edges(spark, monkeypatch):
    from lexicarium.operators import graphs, units

    docs = _shared_containers(spark)
    for rows, batch in ((docs, 3), (docs.where("doc_id >= 10"), 20_000), (docs.limit(0), 3)):
        monkeypatch.setattr(units, "BATCH", batch)
        values = units.values_of(rows)
        got = graphs.adjacency_pairs(values).groupBy("src", "dst").agg(F.sum("n").alias("weight"))
        want = graphs.adjacency_edges(units.split_units(values))
        assert got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_pruned_edges_shuffle_pairs_once_by_either_end(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")  # a table that no other test has cached, which would stand in the plan
    found = __spark_entry__.queries()["pruned_edges"](spark, str(tmp_path))
    found.collect()
    final = _plan(found).split("Initial Plan")[0]
    made = [line for line in final.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(made) - final.count("ReusedExchange") <= 3  # pairs by src, by dst, and the edges that only their second end may keep
    assert "asset_id" not in final  # units were dealt out by container before
