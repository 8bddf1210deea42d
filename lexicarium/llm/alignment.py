"""Cross-tokenizer alignment (operator 13): an event sweep over the token ends of two vocabularies.

Every text (with a space before it) is encoded by vocabulary A (byte-level BPE) and B (SentencePiece).
Each token is an event, its end as a byte offset. The events of both sides are united, dealt out by
document, sorted by offset within the partitions and streamed through a machine: where an A end meets
a B end it closes a group (the tokens since the last such place) and emits a link between the two
tokens that end there. Events travel in blocks of one side and one window of offsets, so a row is
about 16 KB of text, not one token; the machine holds the tokens of the open group and one window.

``aligned_groups`` returns the groups themselves, ``align`` a row per document: counts, a digest of
the groups and how its links stand in the corpus: ``count_sum`` adds up, over its links, how many
links corpus-wide hold the same pair of ids, ``n_best`` counts the links whose pair is the most
frequent of their B id (ties included).

Pairs are looked up in two ways at once, at every size: the few pairs that hold more than one in
``HOT_PAIRS`` of all links (at most that many by arithmetic) are broadcast; the others, of which none
is frequent, meet their counts by a shuffle on the pair. No key of either path is hot.

Defined results: null and empty texts, and texts that A's or B's tokens do not spell out byte for
byte, have zeros and an empty ``groups_sha256``; repeated rows and null ids are documents of their
own (an internal row number is the key); an empty table gives an empty table; other columns are not
carried. Offsets are 64-bit. One text is tokenised in one task; its events are one group of rows,
streamed, so a very long text costs time in one task but no memory there beyond its distinct pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicarium.llm.bpe import rank_bytes
from lexicarium.llm.store import written
from lexicarium.llm.vocabularies import ByteVocabulary, PieceVocabulary, load

#: Bytes of text whose token ends share a block of events.
WINDOW = 16_384
#: At most this many pairs can each hold more than one in HOT_PAIRS of all links.
HOT_PAIRS = 500_000
#: Links held back before a document's pairs are summed up once more.
HELD_LINKS = 1 << 18

A, B = 0, 1
_BLOCK = pa.schema([("row_", pa.int64()), ("doc_id", pa.int64()), ("window_", pa.int64()), ("side_", pa.int8()), ("first_", pa.int64()), ("ids_", pa.binary())])
BLOCK = "row_ long, doc_id long, window_ long, side_ byte, first_ long, ids_ binary"


def _blocks(vocabulary, ids: np.ndarray, window: int) -> Iterator[tuple[int, int, bytes]]:
    """(window, offset at which its first token begins, ids in 16 or 32 bits) of every window in which a token ends."""
    ends = np.cumsum(vocabulary.sizes[ids])
    windows = (ends - 1) // window
    edges = np.flatnonzero(np.diff(windows, prepend=-1))
    packed = ids.astype(_id_type(vocabulary))
    for at, stop in zip(edges, [*edges[1:], len(ids)], strict=True):
        yield int(windows[at]), int(ends[at - 1]) if at else 0, packed[at:stop].tobytes()


def _id_type(vocabulary) -> str:
    return "<u2" if len(vocabulary.sizes) <= 1 << 16 else "<u4"


def _event_batches(batches: Iterable[pa.RecordBatch], a_file: Broadcast, b_file: Broadcast, window: int) -> Iterator[pa.RecordBatch]:
    a_side, b_side = load(ByteVocabulary, a_file.value), load(PieceVocabulary, b_file.value)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = []
            for row, doc_id, raw in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                text = raw.decode("utf-8", "replace") if raw else ""
                a = a_side.ids(text) if text else None
                b = b_side.ids(text) if a is not None else None
                if b is None:
                    rows.append((row, doc_id, 0, A, 0, b""))  # a document without tokens still has a row
                    continue
                rows += [(row, doc_id, w, A, first, block) for w, first, block in _blocks(a_side, a, window)]
                rows += [(row, doc_id, w, B, first, block) for w, first, block in _blocks(b_side, b, window)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BLOCK, strict=True)], schema=_BLOCK)


def token_events(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, window: int) -> tuple[DataFrame, Broadcast, Broadcast]:
    """The united end events of both vocabularies in blocks, dealt out by document and sorted by offset within the partitions; and both files."""
    context = docs.sparkSession.sparkContext
    files = [context.broadcast(rank_bytes(p)) for p in (a_path, b_path)]
    inner = docs.select(F.monotonically_increasing_id().alias("row_"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("raw"))
    events = inner.mapInArrow(lambda it: _event_batches(it, *files, window), BLOCK)
    return events.repartition("row_").sortWithinPartitions("row_", "window_", "side_"), *files


class _Side:
    """One vocabulary's tokens since the last closed group, with their ends."""

    def __init__(self, vocabulary):
        self.sizes, self.type = vocabulary.sizes, _id_type(vocabulary)
        self.reset()

    def reset(self) -> None:
        self.ids, self.ends, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def add(self, first: int, packed: bytes) -> None:
        ids = np.frombuffer(packed, self.type).astype(np.int64)
        ends = first + np.cumsum(self.sizes[ids])
        self.ids, self.ends = (np.concatenate([self.ids, ids]), np.concatenate([self.ends, ends])) if len(self.ids) else (ids, ends)
        self.count += len(ids)

    def take(self, n: int) -> np.ndarray:
        taken, self.ids, self.ends = self.ids[:n], self.ids[n:], self.ends[n:]
        return taken


def _closed(a: _Side, b: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(A ids, B ids, index of each group's last A id, of its last B id) of the groups that can be closed now."""
    if not len(a.ends) or not len(b.ends):
        return None
    at = np.minimum(np.searchsorted(b.ends, a.ends), len(b.ends) - 1)
    meets = b.ends[at] == a.ends
    last_a, last_b = np.flatnonzero(meets), at[meets]
    if not len(last_a):
        return None
    return a.take(int(last_a[-1]) + 1), b.take(int(last_b[-1]) + 1), last_a, last_b


def _swept(batches: Iterable[pa.RecordBatch], a_side, b_side) -> Iterator[tuple]:
    """(row, doc_id, None or closed groups, None or the document's token counts): groups window by window, the counts last."""
    a, b = _Side(a_side), _Side(b_side)
    now, window, doc_id = None, None, None
    for batch in batches:
        for row, doc, w, side, first, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (row, w) != (now, window) and now is not None:
                closed = _closed(a, b)
                if closed:
                    yield now, doc_id, closed, None
                if row != now:
                    yield now, doc_id, None, (a.count, b.count)
                    a.reset()
                    b.reset()
            now, window, doc_id = row, w, doc
            (b if side == B else a).add(first, packed)
    if now is not None:
        closed = _closed(a, b)
        if closed:
            yield now, doc_id, closed, None
        yield now, doc_id, None, (a.count, b.count)


class _Writer:
    """The text ``a1,a2|b1;a3|b2,b3;`` of closed groups, from tables of every id with each mark behind it."""

    def __init__(self, a_size: int, b_size: int):
        table = lambda n, marks: np.array([b"%d%c" % (i, m) for m in marks for i in range(n)], object)
        self.a, self.b, self.a_size, self.b_size = table(a_size, b",|"), table(b_size, b",;"), a_size, b_size

    def text(self, a_ids, b_ids, last_a, last_b) -> bytes:
        a_marks, b_marks = a_ids.copy(), b_ids.copy()
        a_marks[last_a] += self.a_size
        b_marks[last_b] += self.b_size
        out = np.empty(len(a_ids) + len(b_ids), object)
        groups_a, groups_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        out[np.arange(len(a_ids)) + np.repeat(last_b + 1 - groups_b, groups_a)] = self.a[a_marks]
        out[np.arange(len(b_ids)) + np.repeat(last_a + 1, groups_b)] = self.b[b_marks]
        return b"".join(out.tolist())


_SUMMARY = pa.schema(
    [("row_", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), ("pairs_", pa.list_(pa.int64())), ("times_", pa.list_(pa.int64()))]
)
SUMMARY = "row_ long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs_ array<long>, times_ array<long>"


def _sums(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    values, place = np.unique(np.concatenate(pairs), return_inverse=True)
    return [values], [np.bincount(place, weights=np.concatenate(times), minlength=len(values)).astype(np.int64)]


def _summary_batches(batches: Iterable[pa.RecordBatch], a_file: Broadcast, b_file: Broadcast, held: int) -> Iterator[pa.RecordBatch]:
    a_side, b_side = load(ByteVocabulary, a_file.value), load(PieceVocabulary, b_file.value)
    writer = _Writer(len(a_side.sizes), len(b_side.sizes))
    rows: list[tuple] = []
    size = 0
    sha, groups, pairs, times = None, 0, [], []
    for row, doc_id, closed, counts in _swept(batches, a_side, b_side):
        if closed:
            a_ids, b_ids, last_a, last_b = closed
            text = writer.text(*closed)
            if sha is None:
                sha = hashlib.sha256()
            else:
                sha.update(b";")
            sha.update(memoryview(text)[:-1])  # the last mark waits for another group
            groups += len(last_a)
            pairs.append(a_ids[last_a] << 32 | b_ids[last_b])
            times.append(np.ones(len(last_a), np.int64))
            if sum(map(len, pairs)) > 2 * held:
                pairs, times = _sums(pairs, times)
        if counts:
            if pairs:
                pairs, times = _sums(pairs, times)
                size += len(pairs[0])
            # both texts end together, so every token lies in a closed group
            rows.append((row, doc_id, *counts, groups, groups, sha.hexdigest() if sha else "", pairs[0] if pairs else [], times[0] if times else []))
            sha, groups, pairs, times = None, 0, [], []
            if size > held or len(rows) >= 2048:
                yield _summary_batch(rows)
                rows, size = [], 0
    if rows:
        yield _summary_batch(rows)


def _summary_batch(rows: list[tuple]) -> pa.RecordBatch:
    *plain, pairs, times = zip(*rows, strict=True)
    ends = np.cumsum([0, *map(len, pairs)]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x).astype(np.int64))) for x in (pairs, times)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(plain, _SUMMARY, strict=False)] + lists, schema=_SUMMARY)


_GROUPS = pa.schema([("row_", pa.int64()), ("doc_id", pa.int64()), ("first_group", pa.int64()), ("a_ids", pa.list_(pa.list_(pa.int64()))), ("b_ids", pa.list_(pa.list_(pa.int64())))])
GROUPS = "row_ long, doc_id long, first_group long, a_ids array<array<long>>, b_ids array<array<long>>"


def _group_batches(batches: Iterable[pa.RecordBatch], a_file: Broadcast, b_file: Broadcast) -> Iterator[pa.RecordBatch]:
    a_side, b_side = load(ByteVocabulary, a_file.value), load(PieceVocabulary, b_file.value)
    done = 0
    for row, doc_id, closed, counts in _swept(batches, a_side, b_side):
        if closed:
            lists = [np.split(ids, last[:-1] + 1) for ids, last in zip(closed[:2], closed[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((row, doc_id, done, *lists), _GROUPS, strict=True)], schema=_GROUPS)
            done += len(closed[2])
        if counts:
            done = 0


def aligned_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """A row per document and window of text: doc_id, first_group (its number in the document), a_ids and b_ids, the ids of each group on both sides."""
    events, *files = token_events(docs, a_path, b_path, id_col, text_col, window)
    return events.mapInArrow(lambda it: _group_batches(it, *files), GROUPS).drop("row_")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot_pairs: int = HOT_PAIRS, held_links: int = HELD_LINKS) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    events, *files = token_events(docs, a_path, b_path, id_col, text_col, window)
    table = written(events.mapInArrow(lambda it: _summary_batches(it, *files, held_links), SUMMARY), "alignment")
    links = table.select("row_", F.inline(F.arrays_zip("pairs_", "times_"))).toDF("row_", "pair_", "times_")
    counted = links.groupBy("pair_").agg(F.sum("times_").alias("links_"))
    counts = written(counted.withColumn("b_", F.col("pair_").bitwiseAND(F.lit(0xFFFFFFFF))), "pair-counts")
    most = counts.groupBy("b_").agg(F.max("links_").alias("most_"))  # at most a row an id of B's vocabulary
    marked = counts.join(F.broadcast(most), "b_").select("pair_", "links_", (F.col("links_") == F.col("most_")).cast("long").alias("best_"))
    total = counts.agg(F.sum("links_")).first()[0] or 0
    is_hot = F.col("links_") * F.lit(hot_pairs) > F.lit(total)
    hot = F.broadcast(marked.where(is_hot))
    sums = lambda df: df.groupBy("row_").agg(F.sum(F.col("times_") * F.col("links_")).alias("count_sum"), F.sum(F.col("times_") * F.col("best_")).alias("n_best"))
    cold = links.join(hot.select("pair_"), "pair_", "left_anti").join(marked.where(~is_hot), "pair_")
    scores = sums(links.join(hot, "pair_")).unionByName(sums(cold)).groupBy("row_").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return table.join(scores, "row_", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
