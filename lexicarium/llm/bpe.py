"""Byte-level BPE encoding and decoding with a local rank file (operator 3).

``encode_decode(docs, ranks_path)`` keeps every column of ``docs`` and appends ``token_ids``
(array<int>), ``n_tokens``, ``ids_sha256``, ``decoded_sha256``. An input column that already
has one of those names (in any case) is replaced.

Defined results: null text counts as the empty text (0 tokens, the digests of no bytes); an
empty table gives an empty table; repeated rows are encoded each for itself; text bytes that
are not UTF-8 become U+FFFD, as in a Python decode with ``errors="replace"``.

Long texts are cut before tokenising at *safe boundaries* only: places where no match of the
split pattern can cross, so the pieces give exactly the ids of the whole text while no regex
run sees an unbounded string (``_CUT`` states them).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts longer than this many characters are cut at safe boundaries into pieces near this size.
PIECE_CHARS = 16_384

#: No match of PATTERN holds a letter followed by white space, a digit or a mark, a number
#: followed by something that is not a number, or a mark followed by white space: at each of
#: these a match ends, and the lookahead of ``\s+(?!\S)`` sees only white space that follows.
_CUT = regex.compile(r"(?<=\p{L})(?=[^\p{L}])|(?<=\p{N})(?=[^\p{N}])|(?<=[!-/:-@\[-`{-~])(?=[ \n])")

OUTPUT = T.StructType(
    [
        T.StructField("token_ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def rank_bytes(path: str) -> bytes:
    """The rank file whole: a vocabulary of bounded size, read on the driver and broadcast."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut text into pieces of about ``size`` characters at safe boundaries; concatenated they are text.

    A run without a safe boundary (one huge word) stays whole: it is one match of the pattern.
    """
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PIECE_CHARS:
        return enc.encode_ordinary(text)
    return [i for piece in safe_pieces(text) for i in enc.encode_ordinary(piece)]


def _encode_batches(batches: Iterable[pa.RecordBatch], ranks, pattern: str) -> Iterator[pa.RecordBatch]:
    enc = _encoding(ranks.value, pattern)
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            flat, ends, ids_sha, out_sha = [], [0], [], []
            for raw in part.column(part.num_columns - 1):
                value = raw.as_py()
                ids = encode_text(enc, value.decode("utf-8", "replace")) if value else []
                packed = np.asarray(ids, "<u4")
                flat.append(packed.astype(np.int32))
                ends.append(ends[-1] + len(ids))
                ids_sha.append(hashlib.sha256(packed.tobytes()).hexdigest())
                out_sha.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            tokens = pa.ListArray.from_arrays(pa.array(np.asarray(ends, np.int32)), pa.array(np.concatenate(flat)))
            new = [tokens, pa.array(np.diff(ends).astype(np.int64)), pa.array(ids_sha), pa.array(out_sha)]
            names = [f"c{i}" for i in range(part.num_columns - 1)] + OUTPUT.names
            yield pa.RecordBatch.from_arrays(part.columns[:-1] + new, names=names)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str = PATTERN, text_col: str = "text") -> DataFrame:
    """Append token ids, their count and both digests to every row of docs; one pass, no shuffle."""
    spark: SparkSession = docs.sparkSession
    ranks = spark.sparkContext.broadcast(rank_bytes(ranks_path))
    taken = {n.lower() for n in OUTPUT.names}
    keep = [c for c in docs.columns if c.lower() not in taken]
    # positional names inside the task: clashing or odd column names of the input cannot matter
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").cast("binary").alias("raw"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in inner.schema.fields[:-1]] + OUTPUT.fields)
    out = inner.mapInArrow(lambda it: _encode_batches(it, ranks, pattern), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *OUTPUT.names)
