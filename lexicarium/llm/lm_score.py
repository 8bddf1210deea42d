"""LM scoring by a weighted backoff automaton (operator 5).

Tokens: the text's bytes with A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end token.
The model is a trigram with Dirichlet smoothing, as an automaton. Its states are the root, the words and
the pairs of words (the start of a text among them) that training holds; a state h of order k has

- an arc for every word w seen after it, ``log10 (c(h w) + m_k P(w | h')) / (c(h) + m_k)``, which leads to the longest
  state that ends in w;
- a failure arc ``log10 m_k / (c(h) + m_k)`` to h', h without its first word.

The root's arcs are the base ``log10 P(w) = log10 (c(w)+1)/(N+1*(V+1))`` for every word, known or not. A text is
traversed once from left to right: each token is read at the state that the tokens before it led to, failure arcs are
followed until an arc takes it, and the weights add up (``traverse``). Each state's arcs and failure mass sum to one.

The model grows with the corpus and is never broadcast. Texts are packed into blocks; a block asks for the counts of
its distinct n-grams only:

1. blocks: token streams as ranks into the block's sorted token hashes (shared-folder table);
2. requests (bucket of leading hash bits, block, keys, the block's own training counts) are shuffled by
   bucket; counts of equal keys are summed and sent back to each asking block, aligned with its keys. A
   frequent n-gram is one key a block, not one a use;
3. each block meets its totals, builds its part of the automaton and traverses its texts.

A block is about ``BLOCK_BYTES`` of text, so a task's memory is bounded. Buckets hold ``BUCKET_KEYS`` keys at a corpus of 1 GB and grow with
it up to ``MOST_KEYS``, so the requests, a row for each block and bucket, grow in proportion to the corpus up to ten GB of text;
beyond that there are more buckets and requests get shorter, to one key at about 100 TB (each key travels once a block in any case).

Keys are hashes of 40 bits within a bucket. Defined results: null text is the empty text (one end token); repeated
rows are scored (and learned from) each; a null doc_id is scored, not held out and not learned
from; without training texts the base score is log10(1/1) = 0 per token; an empty table gives an
empty table.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicarium.llm.store import written

BLOCK_BYTES = 8 << 20
BUCKET_KEYS = 400_000
MOST_KEYS = 4_000_000
#: Positions that are traversed at once, to the end of a text.
SLICE_TOKENS = 200_000
#: Weights m of the shorter history's distribution in the states of one and of two words, in tokens; of seven pairs tried on sf0.1 the region of the best held-out likelihood.
PRIOR_TOKENS = (400.0, 40.0)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_START, _END = np.uint64(xxhash.xxh64_intdigest(b"\t")), xxhash.xxh64_intdigest(b"\n")  # no word holds white space

BLOCK_SCHEMA = "block string, doc_ids array<long>, held array<boolean>, learn array<boolean>, lengths array<int>, vocabulary binary, stream binary, n_keys long"
RESULT_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def pack(values: np.ndarray) -> bytes:
    """Sorted or small unsigned integers as byte planes of their differences: the high planes are all zero and compress away."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return _planes(steps)


def unpack(data: bytes, kind=np.uint64) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def _block(ids, held, learn, raws) -> tuple:
    index: dict[bytes, int] = {}
    stream, lengths = [], []
    for raw in raws:
        words = raw.lower().split() if raw else []  # bytes: A-Z only, and exactly \x20 \x09-\x0D part words
        lengths.append(len(words) + 1)
        stream.extend([index.setdefault(w, len(index)) for w in words])
        stream.append(-1)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in index] + [_END], np.uint64)
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    tokens = rank[np.array(stream, np.int64)]  # -1: the end token, last of hashes
    packed = zlib.compress(_planes(tokens.astype("<u4")), 1)
    return uuid.uuid4().hex, ids, held, learn, lengths, pack(hashes[order]), packed, len(hashes) + 2 * len(tokens)


def _joined(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    mixed = (before ^ (before >> np.uint64(31))) * _MIX + h
    return (mixed ^ (mixed >> np.uint64(32))) * _MIX


def ngrams(vocabulary: np.ndarray, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of (previous word or start, word) and of (the two before, word) at every position; a text's first position has no third order and repeats the second."""
    h = vocabulary[tokens]
    first = np.cumsum(lengths)[:-1]
    before = np.concatenate([[_START], h[:-1]])
    before[first] = _START
    pair = _joined(before, h)
    before = np.concatenate([pair[:1], pair[:-1]])  # the pair that ends at the word before
    triple = _joined(before, ~h)
    start = np.concatenate([[0], first])
    triple[start] = pair[start]
    return pair, triple


def block_keys(vocabulary: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The block's sorted distinct keys (bucket and 40 bits, the last telling words from longer n-grams) and where its words, pairs and triples stand among them."""
    n, v = len(tokens), len(vocabulary)
    shift, one = np.uint64(24 - bits), np.uint64(1)
    keys = np.empty(v + 2 * n, np.uint64)
    keys[v : v + n], keys[v + n :] = ngrams(vocabulary, tokens, lengths)
    keys[:v] = vocabulary
    keys >>= shift
    keys[:v] |= one
    keys[v:] &= ~one
    # as np.unique with its inverse, by 32-bit positions: a block's memory is a task's memory
    order = keys.argsort().astype(np.int32)
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    at = np.empty(len(keys), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    del order
    return keys[new], at[:v][tokens], at[v : v + n], at[v + n :]


def _to_blocks(batches: Iterable[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("raw")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = np.cumsum(sizes) // block_bytes
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:], strict=False):
            if end > start:
                part = batch.slice(start, end - start)
                row = _block(*(part.column(c).to_pylist() for c in ("doc_id", "held", "learn", "raw")))
                yield _rows([row], BLOCK_TYPES)


BLOCK_TYPES = {"block": pa.string(), "doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "learn": pa.list_(pa.bool_()), "lengths": pa.list_(pa.int32()), "vocabulary": pa.binary(), "stream": pa.binary(), "n_keys": pa.int64()}
REQUEST_TYPES = {"bucket": pa.int64(), "block": pa.string(), "keys": pa.binary(), "counts": pa.binary()}
TOTAL_TYPES = {"bucket": pa.int64(), "block": pa.string(), "totals": pa.binary(), "n_distinct": pa.int64(), "mass": pa.int64()}
RESULT_TYPES = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}


def _rows(rows: list[tuple], types: dict) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """vocabulary, tokens, lengths, and whether each position is learned from."""
    vocabulary, lengths = unpack(row["vocabulary"]), np.array(row["lengths"], np.int64)
    tokens = _plain(zlib.decompress(row["stream"]), "<u4").astype(np.int64)
    return vocabulary, tokens, lengths, np.repeat(np.array(row["learn"], bool), lengths)


def _requests(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            vocabulary, tokens, lengths, learn = _open(row)
            keys, words, pairs, triples = block_keys(vocabulary, tokens, lengths, bits)
            inner = learn.copy()
            inner[np.cumsum(lengths) - lengths] = False  # where a text starts there is no triple
            counts = np.zeros(len(keys), np.uint32)
            for where, use in ((words, learn), (pairs, learn), (triples, inner)):
                counts += np.bincount(where[use], minlength=len(keys)).astype(np.uint32)
            del vocabulary, tokens, words, pairs, triples, where, use, inner, learn
            edges = [*np.flatnonzero(np.diff(keys >> np.uint64(40), prepend=np.uint64(1 << 24))).tolist(), len(keys)]
            spans = list(zip(edges, edges[1:], strict=False))
            for a in range(0, len(spans), 128):
                yield _rows([(int(keys[b]) >> 40, row["block"], pack(keys[b:c] & np.uint64((1 << 40) - 1)), _planes(counts[b:c])) for b, c in spans[a : a + 128]], REQUEST_TYPES)


def _planes(values: np.ndarray) -> bytes:
    """The bytes of an integer array, plane by plane."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def _plain(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _sum_bucket(table: pa.Table) -> pa.Table:
    """Totals of one bucket's keys, to every block that asked; the first answer carries the bucket's distinct words and their mass."""
    rows = table.select(["bucket", "block", "keys", "counts"]).to_pylist()
    keys = [unpack(r["keys"]) for r in rows]
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, weights=np.concatenate([_plain(r["counts"], "<u4") for r in rows])).astype(np.uint64)
    words = totals[(found & np.uint64(1)) == 1]
    ends = np.cumsum([len(k) for k in keys])
    out = []
    for i, (r, end, k) in enumerate(zip(rows, ends, keys, strict=True)):
        mine = totals[at[end - len(k) : end]]
        out.append((r["bucket"], r["block"], zlib.compress(_planes(mine), 1), int((words > 0).sum()) if i == 0 else 0, int(words.sum()) if i == 0 else 0))
    return pa.Table.from_batches([_rows(out, TOTAL_TYPES)])


def traverse(words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, first: np.ndarray, starts: float, n_train: int, n_types: int, prior: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """(base, score) of every position, from the training counts of the word, pair and triple that end there; first: where texts start; starts: how many texts training holds.

    ``state`` is what the traversal carries: 2, 1 or 0 for the longest state that the tokens before a position end in.
    """
    root = np.log10((words + 1) / (n_train + 1.0 * (n_types + 1)))
    held = [None, np.concatenate([[starts], words[:-1]]), np.concatenate([[0.0], pairs[:-1]])]  # c of the states of one and two words
    held[1][first], held[2][first] = starts, 0
    arcs, seen, fail = [root], [None, pairs, triples], [None]
    for k in (1, 2):
        arcs.append(np.log10((seen[k] + prior[k - 1] * 10.0 ** arcs[k - 1]) / (held[k] + prior[k - 1])))
        fail.append(np.log10(prior[k - 1] / (held[k] + prior[k - 1])))
    state = np.where(held[2] > 0, 2, np.where(held[1] > 0, 1, 0))
    score, waiting = np.zeros(len(words)), np.arange(len(words))
    while len(waiting):  # at most two failures
        at = state[waiting]
        taken = at == 0
        for k in (1, 2):
            taken |= (at == k) & (seen[k][waiting] > 0)
        for k in (0, 1, 2):
            here = waiting[taken & (at == k)]
            score[here] += arcs[k][here]
            if k:
                here = waiting[~taken & (at == k)]
                score[here] += fail[k][here]
        waiting = waiting[~taken]
        state[waiting] -= 1
    return root, score


def _score_block(blocks: pa.Table, totals: pa.Table, bits: int, n_train: int, n_types: int, prior: tuple[float, float], slice_tokens: int) -> pa.Table:
    """Build the block's part of the automaton and traverse its texts."""
    rows = []
    for row in blocks.to_pylist():
        vocabulary, tokens, lengths, _ = _open(row)
        found = sorted(totals.to_pylist(), key=lambda r: r["bucket"])
        count = np.concatenate([_plain(zlib.decompress(r["totals"]), "<u8") for r in found])
        keys, words, pairs, triples = block_keys(vocabulary, tokens, lengths, bits)
        del keys, tokens, found
        starts = float(count[words[-1]])  # the last word is an end: as many as starts
        ends = np.cumsum(lengths)
        cut = np.flatnonzero(np.diff(ends // slice_tokens, append=-1))  # the last text of each slice
        for a, b in zip(np.concatenate([[0], cut[:-1] + 1]), cut + 1, strict=True):
            at = slice(ends[a] - lengths[a], ends[b - 1])
            first = ends[a:b] - lengths[a:b] - at.start
            known, seen = count[words[at]].astype(np.float64), count[triples[at]].astype(np.float64)
            seen[first] = 0
            base, score = traverse(known, count[pairs[at]].astype(np.float64), seen, first, starts, n_train, n_types, prior)
            rows += zip(row["doc_ids"][a:b], row["held"][a:b], lengths[a:b].tolist(), np.add.reduceat((known > 0).astype(np.int64), first).tolist(), np.add.reduceat(base, first).tolist(), np.add.reduceat(score, first).tolist(), strict=True)
    return pa.Table.from_batches([_rows(rows, RESULT_TYPES)])


def score_corpus(docs: DataFrame, fold: int = 7, held_fold: int = 2, prior: tuple[float, float] = PRIOR_TOKENS, block_bytes: int = BLOCK_BYTES, slice_tokens: int = SLICE_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row a row of docs."""
    part = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % fold
    keyed = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(part == held_fold, F.lit(False)).alias("held"),
        F.coalesce(part != held_fold, F.lit(False)).alias("learn"),
        F.col(f"`{text_col}`").cast("binary").alias("raw"),
    )
    size = keyed.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0)).alias("n")).first().n
    blocks = written(keyed.mapInArrow(lambda it: _to_blocks(it, block_bytes), BLOCK_SCHEMA), "lm-blocks")
    keys = blocks.agg(F.coalesce(F.sum("n_keys"), F.lit(0)).alias("n")).first().n
    bits = min(24, max(0, int(np.ceil(np.log2(max(1.0, keys / min(MOST_KEYS, BUCKET_KEYS * max(1 / 16, size / 1e9))))))))
    asked = blocks.mapInArrow(lambda it: _requests(it, bits), "bucket long, block string, keys binary, counts binary")
    totals = written(asked.groupBy("bucket").applyInArrow(_sum_bucket, "bucket long, block string, totals binary, n_distinct long, mass long"), "lm-totals")
    whole = totals.agg(F.coalesce(F.sum("n_distinct"), F.lit(0)).alias("v"), F.coalesce(F.sum("mass"), F.lit(0)).alias("n")).first()
    n_train, n_types = int(whole.n), int(whole.v)
    # what is asked and answered only: the other columns stay behind
    answers = totals.select("block", "bucket", "totals")
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda a, b: _score_block(a, b, bits, n_train, n_types, prior, slice_tokens), RESULT_SCHEMA)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")
