"""Contracts against payloads with one defect of each kind."""

from lexicarium.operators import contracts

NODES = "conversation_id string, node_id string, node_order int, parent_id string, child_ids array<string>"


def errors(spark, rows):
    return sorted((tuple(r) for r in contracts.node_violations(spark.createDataFrame(rows, NODES)).collect()), key=lambda r: (r[0], r[1] or "", r[2]))


def test_sound_conversation_has_no_violation(spark):
    assert errors(spark, [("c", "a", 0, None, ["b", "d"]), ("c", "b", 1, "a", []), ("c", "d", 2, "a", None)]) == []
    assert errors(spark, []) == []


def test_each_node_violation(spark):
    assert errors(spark, [("c", "a", 0, None, []), ("c", "b", 1, "a", [])]) == [("c", "b", "not_listed")]
    assert errors(spark, [("c", "a", 0, None, ["b"]), ("c", "b", 1, None, [])]) == [("c", "a", "other_parent")]
    assert errors(spark, [("c", "a", 0, None, ["x"]), ("c", "b", 1, "y", [])]) == [("c", "a", "child_missing"), ("c", "b", "parent_missing")]
    assert errors(spark, [("c", "a", 0, None, ["b", "b"]), ("c", "b", 1, "a", [])]) == [("c", "a", "repeated_child")]
    assert errors(spark, [("c", "a", 0, None, []), ("c", "b", 2, None, [])]) == [("c", None, "node_order")]
    assert errors(spark, [("c", "a", 0, "a", ["a"])]) == [("c", None, "no_root"), ("c", "a", "self_reference")]
    assert errors(spark, [("c", "a", 0, None, []), ("c", "a", 1, None, [])]) == [("c", "a", "repeated_node")]
    # the same ids in another conversation are other nodes
    assert errors(spark, [("c", "a", 0, None, []), ("d", "b", 0, "a", [])]) == [("d", None, "no_root"), ("d", "b", "parent_missing")]


def test_annotation_errors_with_nulls(spark):
    a = spark.createDataFrame([(1, "p", "ok", 0, 2, 0.5), (2, None, "ok", 0, 2, 1.0), (3, "p", None, -1, 2, None), (4, "p", "no", 2, 2, 1.5)], "annotation_id int, path string, resolution_status string, span_start int, span_end int, confidence double")
    got = {r.annotation_id: r.errors for r in contracts.annotation_errors(a, ["path"], ["ok"]).collect()}
    assert got == {2: ["missing_path"], 3: ["resolution_status", "span", "confidence"], 4: ["resolution_status", "span", "confidence"]}


def test_side_table_problems(spark):
    side = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "x"), (9, "z"), (5, None)], "k int, v string")
    canonical = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None)], "k int, v string")
    got = {r.problem: r.n for r in contracts.side_table_problems(side, canonical, "k", "v").collect()}
    assert got == {"duplicate_key": 1, "canonical_missing": 1, "side_missing": 1, "payload_mismatch": 1}


def test_changed_source_is_not_authorized(spark):
    values = spark.createDataFrame([("a", "/p", 0, "h1"), ("b", "/p", 0, "h2")], "asset_id string, path string, value_index int, source_value_sha1 string")
    units = spark.createDataFrame([("a", "/p", 0, "h1"), ("a", "/p", 0, "h1"), ("b", "/p", 0, "old"), (None, "/p", 0, "h"), ("c", "/p", -1, "h")], values.schema)
    assert [r.asset_id for r in contracts.authorized(values, contracts.source_coordinates(units)).collect()] == ["a"]
    assert contracts.access_manifest(units).first().asDict() == {"coordinates": 2, "assets": 2, "paths": 1, "invalid": 2}


def test_ledgers(spark):
    log = spark.createDataFrame([("r", 1, 1, "started"), ("r", 2, 2, "failed"), ("s", 1, 3, "started")], "run_id string, at int, seq int, status string")
    assert {r.run_id: (r.state, r.events) for r in contracts.run_states(log, ["at", "seq"], ["failed", "done"]).collect()} == {"r": ("failed", 2), "s": ("running", 1)}
    d = spark.createDataFrame([("d",), ("e",)], "delivery_id string")
    i = spark.createDataFrame([("d", 1, "queued"), ("d", 2, "indexed")], "delivery_id string, event_id int, status string")
    assert {r.delivery_id: (r.index_events, r.index_status) for r in contracts.delivery_status(d, i).collect()} == {"d": (2, "indexed"), "e": (0, "not_requested")}


def test_messages_parts_and_event_times(spark):
    ref = {"source_file_id": "f", "source_path": "", "source_index": 0, "source_id": None, "source_value_sha256": "a" * 64, "mapping_method": "direct", "loss_status": "lossless"}
    part = lambda k, **x: {"part_id": f"p{k}", "part_index": k, "part_type": "text", "text": "t", "source_ref": ref} | x
    event = lambda **x: {"event_kind": "created", "raw_type": "iso8601", "normalized_utc": "2024-01-01T00:00:00.5Z", "semantic_status": "verified", "source_ref": ref} | x
    message = lambda k, **x: {"conversation_id": "c", "node_id": f"n{k}", "message_id": f"m{k}", "role": "user", "source_role": "human", "content_type": "text", "parts": [part(0), part(1)], "event_times": [event()], "source_ref": ref} | x
    cases = [
        ({}, []),
        ({"parts": [], "event_times": []}, []),
        ({"message_id": None, "role": "bot", "source_role": "", "content_type": None}, ["message_id", "role", "source_role", "content_type"]),
        ({"parts": None, "event_times": None}, ["parts", "event_times"]),
        ({"parts": [part(0), part(1, part_id="p0")]}, ["repeated_part_id"]),
        ({"parts": [part(1), part(1, part_type="poem"), part(2, part_id="")]}, ["part.part_index", "part.part_type", "part.part_id", "repeated_part_id"]),
        ({"parts": [part(0, text=None), part(1, text=None, part_type="image")]}, ["part.text"]),
        ({"event_times": [event(), event()]}, ["repeated_event_time"]),
        ({"event_times": [event(event_kind=None, raw_type="x", normalized_utc="2024-01-01T00:00:00", semantic_status=None)]}, ["event_time.event_kind", "event_time.raw_type", "event_time.normalized_utc", "event_time.semantic_status"]),
        ({"event_times": [event(normalized_utc=u) for u in ("2024-13-01T00:00:00Z",)]}, ["event_time.normalized_utc"]),
        ({"event_times": [event(normalized_utc=None)]}, []),
        ({"source_ref": None}, ["message.source_file", "message.source_path", "message.source_sha256", "message.mapping_method", "message.loss_status"]),
        ({"source_ref": ref | {"source_index": -1, "source_value_sha256": "A" * 64}}, ["message.source_index", "message.source_sha256"]),
    ]
    rows = [message(k, **x) for k, (x, _) in enumerate(cases)] + [message(99, message_id="m0", conversation_id="d")]
    df = spark.createDataFrame(rows, contracts.MESSAGE)
    found = {}
    for r in contracts.message_violations(df).collect():
        found.setdefault(r.node_id, []).append(r.error)
    expected = {f"n{k}": sorted(set(e)) for k, (_, e) in enumerate(cases) if e}
    expected["n0"] = expected["n99"] = ["repeated_message_id"]
    assert {k: sorted(v) for k, v in found.items()} == expected
    counts = contracts.message_counts(df).first()
    assert (counts.conversations, counts.messages) == (2, len(rows)) and counts.event_times == sum(len(r["event_times"] or []) for r in rows)
    assert contracts.message_violations(df.limit(0)).count() == 0
