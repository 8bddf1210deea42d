"""Large JSON files of one array, read by byte ranges: a root array, or the array in one field of a root object.

A file is cut into chunks of bytes without regard to its content. Whether a chunk begins inside a
string, and how deep, depends on all bytes before it, so a first pass sums up every chunk for both
cases (quotes met, change of depth if it begins outside or inside a string), a running sum over one
row a chunk settles which case holds, and a second pass lets every chunk read the items whose
separator lies in it, past its end where an item does. A task holds one chunk and one item; nothing
but a row a chunk is ever in one place.

Files are opened by URI through pyarrow's file systems (local and shared folders, object stores,
HDFS). Broken files raise an error that names file and byte: no array where one is expected, an item
without a comma or closing bracket behind it, invalid or empty items, an end within the array, content
after the end, the array's field twice or never; with ``unique_fields`` also a field that an object
inside an item has twice (otherwise its last value counts).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexicarium.operators.sequences import sums_before

CHUNK_BYTES = 16 << 20
READ_BYTES = 1 << 20
#: Rows of a batch that the writer passes on at once.
SLICE_ROWS = 256

_SPACE = b" \t\r\n"
_TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*("?)|[\[\]{},:]', re.S)
_REST_OF_STRING = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*("?)', re.S)
_ESCAPE = re.compile(rb"\\.", re.S)


class JsonArrayError(ValueError):
    """A file that does not hold the array it should."""


def _open(uri: str):
    system, path = pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
    return system.open_input_file(path)


def _escaped(stream, start: int) -> bool:
    """Whether an odd number of backslashes stands right before a place."""
    n = 0
    while start - n > 0:
        stream.seek(start - n - 1)
        if stream.read(1) != b"\\":
            break
        n += 1
    return n % 2 == 1


def _opened_less_closed(text: bytes) -> int:
    return sum(text.count(c) for c in (b"[", b"{")) - sum(text.count(c) for c in (b"]", b"}"))


def summed_up(stream, start: int, end: int) -> tuple[int, int, int, bool]:
    """(quotes, change of depth if the bytes begin outside a string, if inside, nothing but white space) of a range."""
    skip = _escaped(stream, start)
    stream.seek(start)
    quotes, depth, blank, held, left = 0, [0, 0], True, b"", end - start
    while left > 0:
        block = stream.read(min(READ_BYTES, left))
        if not block:
            break
        left -= len(block)
        if start == 0 and block.startswith(b"\xef\xbb\xbf"):
            block = block[3:]
        blank = blank and not block.strip(_SPACE)
        block, start = held + (block[1:] if skip else block), -1
        skip, tail = False, len(block) - len(block.rstrip(b"\\"))
        block, held = (block[:-1], block[-1:]) if tail % 2 else (block, b"")
        parts = _ESCAPE.sub(b"", block).split(b'"')
        for side in (0, 1):  # parts of this parity lie outside strings if the range begins on this side
            depth[side] += _opened_less_closed(b"".join(parts[(quotes + side) % 2 :: 2]))
        quotes += len(parts) - 1
    return quotes, depth[0], depth[1], blank


class _Text:
    """Bytes of a stream from a place on, read further on demand."""

    def __init__(self, stream, start: int, size: int):
        stream.seek(start)
        self.stream, self.base, self.data = stream, start, stream.read(size)

    def more(self) -> bool:
        block = self.stream.read(max(READ_BYTES, len(self.data) // 2))
        self.data += block
        return bool(block)


def _tokens(text: _Text, at: int, inside: bool) -> Iterator[tuple[int, int]]:
    """(begin, end) in text.data of every string and structural character outside strings; a string that the place lies in is passed over."""
    while True:
        match = _REST_OF_STRING.match(text.data, at) if inside else _TOKEN.search(text.data, at)
        if match is None:
            at = len(text.data)
            if not text.more():
                return
            continue
        if not match.group(1) and (inside or text.data[match.start()] == 0x22):
            if not text.more():
                raise JsonArrayError(f"the file ends within a string that begins before byte {text.base + len(text.data)}")
            continue
        if not inside:
            yield match.start(), match.end()
        inside, at = False, match.end()


def _parsed(raw: bytes, uri: str, at: int, unique: bool) -> str:
    def once(pairs):
        found = dict(pairs)
        if unique and len(found) < len(pairs):
            raise JsonArrayError(f"{uri}: a field stands twice in an object of the item at byte {at}")
        return found

    text = raw.decode("utf-8").strip()
    try:
        json.loads(text, object_pairs_hook=once if unique else None)
    except json.JSONDecodeError as e:
        raise JsonArrayError(f"{uri}: invalid or incomplete JSON value at byte {at}: {e.msg}") from e
    return text


def items_of(stream, uri: str, start: int, end: int, inside: bool, depth: int, begun: bool, field: str | None, key: str | None, unique: bool) -> Iterator[tuple[int, str]]:
    """(offset, JSON) of the items whose separator lies in start..end; ``key`` is the root field that the range begins in, ``begun`` whether something but white space stands before."""
    text = _Text(stream, start, end - start)
    at = 3 if start == 0 and text.data.startswith(b"\xef\xbb\xbf") else 0
    if inside and _escaped(stream, start):
        at = 1
    stream.seek(start + len(text.data))
    level = 1 if field is None else 2  # depth of the items' separators
    root = b"[" if field is None else b"{"
    item, last_string = None, None  # where the open item begins; the last string at the root object's depth
    checked = at  # bytes before it are accounted for at depth 0
    limit = end - start
    for begin, stop in _tokens(text, at, inside):
        token = text.data[begin : begin + 1]
        if item is None and begin >= limit:
            break
        if depth == 0:
            if text.data[checked:begin].strip(_SPACE) or begun:
                raise JsonArrayError(f"{uri}: unexpected trailing JSON content before byte {start + begin}" if begun else f"{uri}: expected {root.decode()!r} before byte {start + begin}")
            if token != root:
                raise JsonArrayError(f"{uri}: expected {root.decode()!r} at byte {start + begin}")
        if token == b'"':
            last_string = (begin, stop)
        elif token == b":" and depth == 1 and field is not None and last_string:
            key = json.loads(text.data[slice(*last_string)])
        elif token in b"[{":
            depth += 1
            begun = True
            if depth == level and (field is None or (key == field and token == b"[")):
                item = stop if begin < limit else None
            elif depth == level and key == field:
                raise JsonArrayError(f"{uri}: field {field!r} holds no array at byte {start + begin}")
        elif token in b"]}":
            if depth == level and item is not None:
                if token != b"]":
                    raise JsonArrayError(f"{uri}: array closed by '}}' at byte {start + begin}")
                raw = text.data[item:begin]
                if raw.strip(_SPACE) or text.data[item - 1 : item] == b",":
                    yield start + item, _parsed(raw, uri, start + item, unique)
                item = None
            depth -= 1
            checked = stop
        elif token == b"," and depth == level and (field is None or key == field):
            if item is not None:
                yield start + item, _parsed(text.data[item:begin], uri, start + item, unique)
            item = stop if begin < limit else None
        if depth < 0:
            raise JsonArrayError(f"{uri}: unexpected closing bracket at byte {start + begin}")
    if item is not None:
        raise JsonArrayError(f"{uri}: the file ends within the array item at byte {start + item}")
    if depth == 0 and text.data[checked:limit].strip(_SPACE):
        raise JsonArrayError(f"{uri}: unexpected trailing JSON content at byte {start + checked}" if begun else f"{uri}: expected {root.decode()!r} at byte {start + checked}")


def root_keys_of(stream, start: int, end: int, inside: bool, depth: int) -> Iterator[tuple[int, str]]:
    """(offset, name) of the root object's fields whose colon lies in start..end; the name may begin before it."""
    text = _Text(stream, start, end - start)
    at = 1 if inside and _escaped(stream, start) else 0
    stream.seek(start + len(text.data))
    string = None
    for begin, stop in _tokens(text, at, inside):
        token = text.data[begin : begin + 1]
        if begin >= end - start and not (string and depth == 1):
            break
        if token == b'"':
            if begin >= end - start:
                break
            string = (begin, stop) if depth == 1 else None
            continue
        if token == b":" and depth == 1 and string:
            yield start + string[0], json.loads(text.data[slice(*string)])
        depth += (token in b"[{") - (token in b"]}")
        string = None
        if begin >= end - start:
            break


def _chunks(spark: SparkSession, paths: list[str] | str, chunk_bytes: int) -> DataFrame:
    """(path, chunk, start, end, inside, depth, begun, complete): every chunk of the files with the state that it begins in."""
    chunk_bytes = max(chunk_bytes, 4)  # a byte order mark lies in one chunk
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    last = F.greatest(F.ceil(F.col("length") / chunk_bytes) - 1, F.lit(0))
    cut = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"), "length").select("path", "chunk", (F.col("chunk") * chunk_bytes).alias("start"), F.least((F.col("chunk") + 1) * chunk_bytes, "length").alias("end"))
    spread = cut.repartition(min(max(1, cut.count()), 20_000))  # a row a chunk

    def scan(batches):
        for batch in batches:
            out = []
            for path, start, end in zip(batch["path"], batch["start"], batch["end"], strict=True):
                with _open(path) as stream:
                    out.append(summed_up(stream, int(start), int(end)))
            quotes, outside, within, blank = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [], [])
            yield batch.assign(quotes=quotes, outside=outside, within=within, blank=blank)

    summed = spread.mapInPandas(scan, "path string, chunk long, start long, end long, quotes long, outside long, within long, blank boolean")
    before = Window.partitionBy("path").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("path")
    state = summed.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    state = state.withColumn("change", F.when(F.col("inside"), F.col("within")).otherwise(F.col("outside")))
    state = state.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0))).withColumn("begun", F.coalesce(F.bool_or(~F.col("blank")).over(before), F.lit(False)))
    ends_well = (F.sum("change").over(every) == 0) & (F.sum("quotes").over(every) % 2 == 0) & ~F.bool_and("blank").over(every)
    return state.withColumn("complete", ends_well).select("path", "chunk", "start", "end", "inside", "depth", "begun", "complete")


def _state(row) -> tuple[int, int, bool, int]:
    return int(row.start), int(row.end), bool(row.inside), int(row.depth)


def _read(chunks: DataFrame, field: str | None, unique: bool) -> DataFrame:
    def read(batches):
        import pandas as pd

        for batch in batches:
            for row in batch.itertuples(index=False):
                if not row.complete:
                    raise JsonArrayError(f"{row.path}: the file is empty or its brackets or quotes do not close")
                with _open(row.path) as stream:
                    held, size = [], 0
                    for offset, text in items_of(stream, row.path, *_state(row), bool(row.begun), field, row.key, unique):
                        held.append((row.path, offset, text))
                        size += len(text)
                        if size > READ_BYTES:
                            yield pd.DataFrame(held, columns=["path", "offset", "json"])
                            held, size = [], 0
                    if held:
                        yield pd.DataFrame(held, columns=["path", "offset", "json"])

    return chunks.repartition(min(max(1, chunks.count()), 20_000)).mapInPandas(read, "path string, offset long, json string")


def root_array(spark: SparkSession, paths: list[str] | str, chunk_bytes: int = CHUNK_BYTES, unique_fields: bool = False) -> DataFrame:
    """(path, offset, json) of every item of files that hold one array each."""
    return _read(_chunks(spark, paths, chunk_bytes).withColumn("key", F.lit(None).cast("string")), None, unique_fields)


def root_fields(spark: SparkSession, paths: list[str] | str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(path, offset, key) of the root object's fields."""
    return _fields(_chunks(spark, paths, chunk_bytes))


def _fields(chunks: DataFrame) -> DataFrame:
    def keys(batches):
        import pandas as pd

        for batch in batches:
            for row in batch.itertuples(index=False):
                with _open(row.path) as stream:
                    yield pd.DataFrame([(row.path, *found) for found in root_keys_of(stream, *_state(row))], columns=["path", "offset", "key"])

    return chunks.mapInPandas(keys, "path string, offset long, key string")


def object_array(spark: SparkSession, paths: list[str] | str, field: str, chunk_bytes: int = CHUNK_BYTES, unique_fields: bool = False) -> DataFrame:
    """(path, offset, json) of every item of the array in one field of each file's root object."""
    chunks = _chunks(spark, paths, chunk_bytes)
    fields = _fields(chunks)
    times = chunks.select("path").distinct().join(fields.where(F.col("key") == field).groupBy("path").agg(F.count(F.lit(1)).alias("n")), "path", "left").where("n is null or n > 1").orderBy("path").first()
    if times:
        raise JsonArrayError(f"{times.path}: duplicate root field: {field}" if times.n else f"{times.path}: root object is missing array field: {field}")
    both = chunks.select("path", F.col("start").alias("at"), F.lit(None).cast("string").alias("name"), "chunk").unionByName(fields.select("path", F.col("offset").alias("at"), F.col("key").alias("name"), F.lit(None).cast("long").alias("chunk")))
    before = Window.partitionBy("path").orderBy("at", F.col("chunk").isNull()).rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk and root field
    current = both.withColumn("key", F.last("name", True).over(before)).where("chunk is not null").select("path", "chunk", "key")
    return _read(chunks.join(current, ["path", "chunk"]), field, unique_fields)


def numbered(items: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """items with ``index``, their number in the file."""
    return sums_before(items, ["path"], "offset", {"index": F.lit(1).cast("long")}, chunk_bytes)


def inspected(items: DataFrame) -> DataFrame:
    """(path, items, first_item) of files with items; empty arrays have no row here."""
    return items.groupBy("path").agg(F.count(F.lit(1)).alias("items"), F.min_by("json", "offset").alias("first_item"))


def write_arrays(rows: DataFrame, path: str) -> None:
    """rows as JSON arrays, one file a partition; a task puts the marks before slices of a batch as Arrow holds them and makes no Python strings."""

    def bracketed(batches):
        lead = "["
        for batch in batches:
            column, at = batch.column("json"), 0
            while at < batch.num_rows:
                count = 1 if lead == "[" else SLICE_ROWS
                marked = pc.binary_join_element_wise(lead, column.slice(at, count), "")
                yield pa.RecordBatch.from_arrays([marked], ["value"])
                lead, at = ",", at + count
        yield pa.RecordBatch.from_pydict({"value": ["]" if lead == "," else "[]"]})

    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    rows.select(whole.alias("json")).mapInArrow(bracketed, "value string").write.text(path)
