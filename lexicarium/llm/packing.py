"""Best-fit packing (operator 12): length patterns fitted to the histogram by non-negative least squares.

Documents are encoded, closed by an end id and cut into pieces of at most ``capacity`` tokens (only
longer ones are cut). The pieces' lengths are counted; that histogram of at most ``capacity`` numbers
is all the driver sees. There the patterns of few pieces (two or three lengths that fill a sequence
exactly) are enumerated, their repeat counts fitted to the histogram by non-negative least squares,
rounded down to what the histogram holds, and the rest, whose shape no pattern met, is packed by
best fit over lengths in descending order, many pieces of one length at a time. The plan is a list of
*slots*: so many pieces of a length go to consecutive sequences at an offset. Its size follows from
the capacity (at most ``MAX_PATTERNS`` patterns), not from the number of documents.

Each piece then finds its slot by its number among the pieces of its length. Tasks number their own
pieces while they encode; a sum over tasks by length turns that into a number corpus-wide. No group
of pieces meets in one task, so a length that most pieces share costs nothing extra.

Defined results: null and empty texts are one piece, the end id alone; repeated rows and null ids are
documents of their own; an empty table gives an empty table; other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexicarium.llm.bpe import rank_bytes
from lexicarium.llm.store import written
from lexicarium.llm.vocabularies import WordVocabulary, load

CAPACITY, END_ID = 2048, 0
#: Patterns that are fitted at most; with more (large capacities) every so-many-th, and the residual takes more.
MAX_PATTERNS = 500_000
#: Steps of the fit.
STEPS = 200
#: Rows of a side that is broadcast at most; beyond that it is shuffled.
BROADCAST_ROWS = 500_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part_ long, nth_ long"
IDS = ", token_ids array<int>"


def _piece_batches(batches: Iterable[pa.RecordBatch], file: Broadcast, capacity: int, end_id: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    vocabulary = load(WordVocabulary, file.value)
    part, numbers = TaskContext.get().partitionId(), [0] * (capacity + 1)
    end = np.array([end_id], "<i4")
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows, kept = [], []
            for doc_id, raw in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                ids = np.concatenate([vocabulary.ids(raw or b""), end])
                for k, at in enumerate(range(0, len(ids), capacity)):
                    piece = ids[at : at + capacity]
                    length = len(piece)
                    rows.append((doc_id, k, at, length, zlib.crc32(piece.tobytes()), part, numbers[length]))
                    numbers[length] += 1
                    kept += [piece] if keep_ids else []
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            if keep_ids:
                ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in (PIECE + (IDS if keep_ids else "")).split(", ")])


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A table of the shared folder with a row per piece; ``nth_`` numbers the pieces of a length within ``part_``, the task that made them."""
    file = docs.sparkSession.sparkContext.broadcast(rank_bytes(vocabulary_path))
    inner = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("raw"))
    schema = PIECE + (IDS if keep_ids else "")
    return written(inner.mapInArrow(lambda it: _piece_batches(it, file, capacity, end_id, keep_ids), schema), "pieces")


# --- the plan, from the histogram alone -----------------------------------------------------------


def patterns(histogram: np.ndarray) -> np.ndarray:
    """Every pattern of two or three lengths in the histogram that fill the capacity: rows (least, middle, greatest), least 0 for pairs."""
    capacity = len(histogram) - 1
    there = histogram > 0
    there[0] = True
    lengths = np.flatnonzero(there)
    found = []
    for least in lengths[lengths <= capacity // 3]:
        middle = lengths[(lengths >= max(least, 1)) & (lengths <= (capacity - least) // 2)]
        greatest = capacity - least - middle
        ok = there[greatest]
        found.append(np.stack([np.full(int(ok.sum()), least), middle[ok], greatest[ok]], axis=1))
    out = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return out[:: -(-len(out) // MAX_PATTERNS)] if len(out) > MAX_PATTERNS else out


def fitted(histogram: np.ndarray, shapes: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that nearly minimise the sum over lengths of (length * (pieces packed - pieces there))^2.

    Accelerated projected gradient steps with restarts. A length left over costs as the tokens it holds: short pieces
    are what the residual fills gaps with, long ones need a partner.
    """
    size = len(histogram)
    weight = (np.arange(size) / size) ** 2
    weight[0] = 0.0
    flat = shapes.ravel()
    packed = lambda x: np.bincount(flat, weights=np.repeat(x, shapes.shape[1]), minlength=size)
    slope = lambda r: (weight * r)[shapes].sum(axis=1)
    probe = np.ones(len(shapes))
    for _ in range(12):  # the largest eigenvalue, by powers
        probe = slope(packed(probe))
        top = float(np.linalg.norm(probe))
        probe /= top or 1.0
    step = 1 / (1.1 * top or 1.0)
    x = y = np.zeros(len(shapes))
    momentum = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - step * slope(packed(y) - histogram))
        if float((y - new) @ (new - x)) > 0:
            momentum = 1.0
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y, x, momentum = new + (momentum - 1) / grown * (new - x), new, grown
    return x


#: A packed shape: ((length, how many), ...) and how many sequences have it.
Shape = tuple[tuple[tuple[int, int], ...], int]


def rounded(histogram: np.ndarray, shapes: np.ndarray, x: np.ndarray) -> tuple[list[Shape], np.ndarray]:
    """Whole repeat counts that the histogram can pay, most repeated patterns first, and what is left of it."""
    left = histogram.astype(np.int64).copy()
    out: list[Shape] = []
    order = np.argsort(-x, kind="stable")
    order = order[x[order] >= 0.5]
    for shape, wanted in zip(shapes[order].tolist(), np.rint(x[order]).astype(np.int64).tolist(), strict=True):
        runs: dict[int, int] = {}
        for length in reversed(shape):
            if length:
                runs[length] = runs.get(length, 0) + 1
        count = min(wanted, *(int(left[length]) // k for length, k in runs.items()))
        if count > 0:
            out.append((tuple(runs.items()), count))
            for length, k in runs.items():
                left[length] -= k * count
    return out, left


def best_fit(histogram: np.ndarray) -> list[Shape]:
    """Best fit over lengths in descending order; sequences of one shape and one free space are filled together."""
    capacity = len(histogram) - 1
    open_: dict[int, list[tuple[tuple, int]]] = {}  # free space -> (runs, how many sequences)
    for length in range(capacity, 0, -1):
        count = int(histogram[length])
        free = length
        while count and free <= capacity:  # the tightest sequences first
            group = open_.get(free)
            while count and group:
                runs, there = group.pop()
                each = free // length  # pieces of this length that one of them takes
                full = min(there, count // each)
                _put(open_, free - each * length, (*runs, (length, each)), full)
                count -= full * each
                if full < there and 0 < count < each:
                    _put(open_, free - count * length, (*runs, (length, count)), 1)
                    full, count = full + 1, 0
                if full < there:
                    group.append((runs, there - full))
            free += 1
        each = capacity // length
        _put(open_, capacity - each * length, ((length, each),), count // each)
        if count % each:
            _put(open_, capacity - count % each * length, ((length, count % each),), 1)
    return [shape for group in open_.values() for shape in group]


def _put(open_: dict, free: int, runs: tuple, count: int) -> None:
    if count:
        open_.setdefault(free, []).append((runs, count))


def plan(histogram: np.ndarray) -> list[Shape]:
    """Shapes that hold every piece of the histogram once (index: length, 0 to the capacity)."""
    capacity = len(histogram) - 1
    out: list[Shape] = [(((capacity, 1),), int(histogram[capacity]))] if histogram[capacity] else []
    rest = np.append(histogram[:-1], 0)
    shapes = patterns(rest)
    if len(shapes):
        by_pattern, rest = rounded(rest, shapes, fitted(rest, shapes))
        out += by_pattern
    return out + best_fit(rest)


def slots(shapes: list[Shape], histogram: np.ndarray) -> dict[str, np.ndarray]:
    """The plan as arrays in order of length: pieces from number ``first`` on (lengths laid end to end) go to sequences from ``sequence`` on, ``each`` in one, from ``offset`` on."""
    rows, sequence = [], 0
    for runs, count in shapes:
        offset = 0
        for length, each in runs:
            rows.append((length, count * each, sequence, each, offset))
            offset += length * each
        sequence += count
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.argsort(table[:, 0], kind="stable")]
    return {"first": np.cumsum(table[:, 1]) - table[:, 1], "sequence": table[:, 2], "each": table[:, 3], "offset": table[:, 4], "base": np.cumsum(histogram) - histogram}


def _place_batches(batches: Iterable[pa.RecordBatch], plan_: Broadcast) -> Iterator[pa.RecordBatch]:
    p = plan_.value
    for batch in batches:
        length, number = (np.asarray(batch.column(k)) for k in (batch.num_columns - 2, batch.num_columns - 1))
        at = p["base"][length] + number
        slot = np.searchsorted(p["first"], at, side="right") - 1
        within = at - p["first"][slot]
        each = p["each"][slot]
        new = [pa.array(p["sequence"][slot] + within // each), pa.array(p["offset"][slot] + within % each * length)]
        columns = [*batch.columns[:-1], *new]
        yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A table of ``pieces`` with ``sequence_id`` and ``offset``: few sequences of at most ``capacity`` tokens, gapless from offset 0."""
    per_task = written(table.groupBy("part_", "length").agg(F.count(F.lit(1)).alias("n_")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n_")).collect():  # at most a row a length
        histogram[length] = n
    laid = table.sparkSession.sparkContext.broadcast(slots(plan(histogram), histogram))
    before = F.sum("n_").over(Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))
    firsts = per_task.select("part_", "length", F.coalesce(before, F.lit(0)).alias("before_"))
    firsts = F.broadcast(firsts) if per_task.count() <= BROADCAST_ROWS else firsts
    kept = [c for c in table.columns if c not in ("part_", "nth_", "length")]
    inner = table.join(firsts, ["part_", "length"]).select(*kept, "length", (F.col("before_") + F.col("nth_")).alias("number_"))
    types = [f"c{k} {table.schema[c].dataType.simpleString()}" for k, c in enumerate([*kept, "length"])]
    n = len(types)
    out = inner.mapInArrow(lambda it: _place_batches(it, laid), ", ".join([*types, f"c{n} long", f"c{n + 1} long"]))
    return out.toDF(*kept, "length", "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and token_ids with ``keep_ids``."""
    packed = pack(pieces(docs, vocabulary_path, capacity, end_id, keep_ids, id_col, text_col), capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["token_ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, token_ids, doc_ids) of ``pack_documents(..., keep_ids=True)``: the training sequences, each a group of at most the capacity's tokens."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "token_ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(rows.alias("r_")).select("sequence_id", F.flatten("r_.token_ids").alias("token_ids"), F.col("r_.doc_id").alias("doc_ids"))
