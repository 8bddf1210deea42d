"""Appends with receipts, supersession checks and optimistic revisions, as keyed state over a stream.

Requests of one anchor are answered in the order of their time and id, against that anchor's state:
receipts of earlier requests, the annotations it holds, and its head revision. State lives in the
state store an entry a receipt and annotation, so a large anchor is never one value, and is restored
from the checkpoint after a restart; a batch that is replayed gives the answers it gave before.

Outcomes, the first that holds:

* ``existing``: the producer sent this request before with the same content; its revision is returned.
* ``idempotency_conflict``: it sent this request id with other content.
* ``annotation_conflict``: the annotation id is taken.
* ``revision_conflict``: the base revision (null: none yet) is not the head.
* ``supersession_invalid``: it supersedes an annotation that this anchor does not hold with the same type.
* ``persisted``: accepted; the head is now one higher. ``branches`` counts annotations that supersede the
  same one, this one included.

Requests without an anchor or without a request id are not given to the state: ``invalid``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

REQUEST = ["anchor_id", "producer_id", "request_id", "base_revision", "annotation_id", "annotation_type", "supersedes", "content_hash", "request_at"]
ANSWER = "anchor_id string, producer_id string, request_id string, annotation_id string, outcome string, revision long, branches long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def answer(request, head: int, receipt: Callable, kind_of: Callable, branches_of: Callable) -> tuple[str, int | None, int | None]:
    """(outcome, revision, branches) of one request against an anchor's state, given its head and lookups that return None or 0 where nothing is held."""
    held = receipt(request.producer_id, request.request_id)
    if held is not None:
        return ("existing", held[1], None) if held[0] == request.content_hash else ("idempotency_conflict", None, None)
    if kind_of(request.annotation_id) is not None:
        return "annotation_conflict", None, None
    if (request.base_revision or 0) != head:
        return "revision_conflict", None, None
    target = request.supersedes
    if target is not None and kind_of(target) != request.annotation_type:
        return "supersession_invalid", None, None
    return "persisted", head + 1, branches_of(target) + 1 if target is not None else None


class _Held:
    """Entries of a map state as one call sees them: each is read at most once, and written once, with its last value, by ``write``."""

    def __init__(self, state):
        self.state, self.seen, self.new = state, {}, set()

    def get(self, key: tuple):
        if key not in self.seen:
            self.seen[key] = self.state.getValue(key) if self.state is not None else None
        return self.seen[key]

    def put(self, key: tuple, value: tuple) -> None:
        self.seen[key] = value
        self.new.add(key)

    def write(self, state) -> None:
        for key in self.new:
            state.updateValue(key, self.seen[key])


class AppendLedger(StatefulProcessor):
    """State of one anchor: head revision, receipts by request, annotation types, and how many supersede an annotation."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.head = handle.getValueState("head", "revision long")
        self.receipts = handle.getMapState("receipts", "producer_id string, request_id string", "content_hash string, revision long")
        self.kinds = handle.getMapState("kinds", "annotation_id string", "annotation_type string")
        self.branches = handle.getMapState("branches", "annotation_id string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        batch = sorted(rows, key=lambda r: tuple((r[c] is None, r[c]) for c in ("request_at", "request_id", "annotation_id")))
        first = self.head.get()
        start = head = first[0] if first else 0
        # every accepted request moves the head: an anchor without one holds nothing, and the store is not asked
        receipts, kinds, branches = (_Held(state if first else None) for state in (self.receipts, self.kinds, self.branches))
        kind_of = lambda a: (kinds.get((a,)) or (None,))[0]
        branches_of = lambda a: (branches.get((a,)) or (0,))[0]
        for r in batch:
            outcome, revision, n = answer(r, head, lambda p, q: receipts.get((p, q)), kind_of, branches_of)
            if outcome == "persisted":
                head = revision
                receipts.put((r.producer_id, r.request_id), (r.content_hash, revision))
                kinds.put((r.annotation_id,), (r.annotation_type,))
                if n:
                    branches.put((r.supersedes,), (n,))
            yield Row(anchor_id=r.anchor_id, producer_id=r.producer_id, request_id=r.request_id, annotation_id=r.annotation_id, outcome=outcome, revision=revision, branches=n)
        for held, state in ((receipts, self.receipts), (kinds, self.kinds), (branches, self.branches)):
            held.write(state)
        if head != start:
            self.head.update((head,))

    def close(self) -> None:
        pass


def _typed(requests: DataFrame) -> DataFrame:
    text = [c for c in REQUEST if c not in ("base_revision", "request_at")]
    return requests.select(*[F.col(c).cast("string").alias(c) for c in text], F.col("base_revision").cast("long").alias("base_revision"), F.col("request_at").cast("timestamp").alias("request_at"))


_WHOLE = "anchor_id is not null and producer_id is not null and request_id is not null and annotation_id is not null"


def answered(requests: DataFrame) -> DataFrame:
    """Answers to a stream of requests (columns of REQUEST), in update of the anchors' state."""
    rows = _typed(requests).where(_WHOLE)
    return rows.groupBy("anchor_id").transformWithState(AppendLedger(), ANSWER, "append", "none")


def invalid(requests: DataFrame) -> DataFrame:
    """Requests that no anchor's state can answer."""
    return _typed(requests).where(f"not ({_WHOLE})").select("anchor_id", "producer_id", "request_id", "annotation_id", F.lit("invalid").alias("outcome"), F.lit(None).cast("long").alias("revision"), F.lit(None).cast("long").alias("branches"))


def append(requests: DataFrame, ledger: str, checkpoint: str) -> StreamingQuery:
    """Answer what a stream of requests holds now and write the answers below ``ledger``; started again with the same checkpoint it goes on where it stopped.

    The state store must be one that holds maps (RocksDB); it is set for the session here.
    """
    requests.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return answered(requests).writeStream.format("parquet").outputMode("append").option("path", ledger).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_counts(answers: DataFrame) -> DataFrame:
    """(outcome, n): created and skipped requests."""
    return answers.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def folder_stream(spark: SparkSession, folder: str, schema, files_a_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)
