"""Periodic run detection (operator 11): heavy/light lag counting and island scans.

A *run* is a stretch of consecutive words whose smallest period is q (words q apart are equal),
at least ``max(min_words, min_repeats * q)`` words long, which no neighbouring word extends.

Per document, the matches at every lag (pairs of equal words that far apart) are counted exactly:
words that occur often by an autocorrelation with the fast Fourier transform, all others by the
differences of their positions. A run of period q makes ``length - q`` matches at lag q in a row,
so only lags with that many get an island scan; matches that shorter periods explain (multiples of
a period already found) are taken off first, and a scan probes one position a shortest island, so
n words cost about n^1.5 for the counts and n log n for the probes, however repetitive they are.

``find_runs(docs)`` keeps every column and appends ``n_words``, ``runs`` (by start, then period),
``best_run`` and ``collapsed`` (the words without those that a run repeats after its first q,
joined by one space). An input column of one of those names (in any case) is replaced.

Defined results: null and empty texts have no words, no runs, a null ``best_run`` and an empty
``collapsed``; repeated rows are judged each for itself; an empty table gives an empty table. Ties of
the greatest exponent go to the smallest start, then the smallest period. A text is one row and one
task's work: its memory is about 40 bytes a word beside the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Shortest run in words, and the least number of times its period must fit into it.
MIN_WORDS, MIN_REPEATS = 24, 3
#: Texts are cut into words a stretch of about this many bytes at a time.
STRETCH_BYTES = 1 << 20
#: Cells of one batch of transforms: frequent words times transform length.
BATCH_CELLS = 1 << 22
#: Positions tested beside a probe before an island is followed.
NEAR = 8

_SPACE = re.compile(rb"[\x20\x09-\x0D]")

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
OUTPUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("best_run", RUN), T.StructField("collapsed", T.StringType())])


def words_of(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    """(word ids by position, the distinct words) of a text in UTF-8."""
    index: dict[bytes, int] = {}
    parts, at = [], 0
    while at < len(raw):
        edge = _SPACE.search(raw, at + STRETCH_BYTES) if len(raw) - at > STRETCH_BYTES else None
        end = edge.start() if edge else len(raw)
        words = raw[at:end].split()  # bytes.split() parts at exactly \x20 and \x09-\x0D
        parts.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
        at = end
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), list(index)


def lag_matches(ids: np.ndarray, most: int) -> np.ndarray:
    """Pairs of equal ids at each lag 0..most (entry 0 is unused): exact for rare ids, to well under a half for frequent ones."""
    n = len(ids)
    counts = np.bincount(ids)
    heavy_over = max(NEAR, isqrt(n * n.bit_length()) // 4)
    found = np.zeros(most + 1)

    order = np.argsort(ids, kind="stable")
    order = order[counts[ids[order]] <= heavy_over].astype(np.int64)
    key = ids[order]
    at = np.arange(len(order))
    step = 1
    while len(at):  # pairs of the same id that lie `step` occurrences apart
        at = at[at + step < len(order)]
        at = at[key[at + step] == key[at]]
        lags = order[at + step] - order[at]
        near = lags <= most
        found += np.bincount(lags[near], minlength=most + 1)
        at = at[near]  # later occurrences lie further away still
        step += 1

    heavy = np.flatnonzero(counts > heavy_over)
    if len(heavy):
        size = 1 << (n + most).bit_length()
        power = np.zeros(size // 2 + 1)
        batch = max(1, BATCH_CELLS // size)
        for k in range(0, len(heavy), batch):
            marks = (ids[None, :] == heavy[k : k + batch, None]).astype(np.float64)
            spectrum = np.fft.rfft(marks, size, axis=1)
            power += (spectrum.real**2 + spectrum.imag**2).sum(axis=0)
        found += np.fft.irfft(power, size)[: most + 1]
    found[0] = 0
    return found


def _mismatch_after(ids: np.ndarray, at: int, lag: int) -> int:
    """The first position >= at whose word differs from the word a lag on (the end of the pairs if none does)."""
    end, width = len(ids) - lag, 64
    while at < end:
        stop = min(end, at + width)
        differs = ids[at:stop] != ids[at + lag : stop + lag]
        if differs.any():
            return at + int(differs.argmax())
        at, width = stop, width * 4
    return end


def _mismatch_before(ids: np.ndarray, at: int, lag: int) -> int:
    """The last position <= at whose word differs from the word a lag on (-1 if none does)."""
    width = 64
    while at >= 0:
        low = max(0, at + 1 - width)
        differs = ids[low : at + 1] != ids[low + lag : at + 1 + lag]
        if differs.any():
            return at - int(differs[::-1].argmax())
        at, width = low - 1, width * 4
    return -1


def islands(ids: np.ndarray, lag: int, least: int) -> Iterator[tuple[int, int]]:
    """(first, number) of every island: consecutive positions whose word equals the word a lag on, at least ``least`` of them."""
    pairs = len(ids) - lag
    if pairs < least:
        return
    probes = np.arange(least - 1, pairs, least)  # every island of that many covers a probe
    probes = probes[ids[probes] == ids[probes + lag]]
    beside = min(NEAR, (least + 1) // 2)  # on one side of its probe (included) an island has at least half its positions
    steps = np.arange(beside)
    if len(probes):
        right = np.minimum(probes[:, None] + steps, pairs - 1)
        left = np.maximum(probes[:, None] - steps, 0)
        probes = probes[(ids[right] == ids[right + lag]).all(axis=1) | (ids[left] == ids[left + lag]).all(axis=1)]
    done = 0
    for probe in probes.tolist():
        if probe < done:
            continue
        first, done = _mismatch_before(ids, probe, lag) + 1, _mismatch_after(ids, probe, lag)
        if done - first >= least:
            yield first, done - first


def runs_of(ids: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n = len(ids)
    most = n // min_repeats
    if n < min_words or most < 1:
        return []
    matches = lag_matches(ids, most)
    lags = np.arange(most + 1)
    needed = np.maximum(min_words, min_repeats * lags) - lags
    found: dict[tuple[int, int], int] = {}
    for lag in np.flatnonzero(matches > needed - 0.5).tolist():
        # runs of a divisor of this lag have taken their matches off; a run of this period shares none of them
        if lag == 0 or matches[lag] <= needed[lag] - 0.5:
            continue
        for first, number in islands(ids, lag, int(needed[lag])):
            length = number + lag
            if (first, length) in found:
                continue
            found[(first, length)] = lag
            multiples = np.arange(2 * lag, min(length, most + 1), lag)
            matches[multiples] -= length - multiples
    return sorted((start, length, period) for (start, length), period in found.items())


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for run in runs:  # by start, then period, so a tie stays with the earlier one
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_positions(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for words that no run holds after its first ``period`` words."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def _collapse(ids: np.ndarray, words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        ids = ids[kept_positions(len(ids), runs)]
    return b" ".join(map(words.__getitem__, ids.tolist()))


def _find_batches(batches: Iterable[pa.RecordBatch], min_words: int, min_repeats: int) -> Iterator[pa.RecordBatch]:
    struct = pa.struct([(f.name, pa.int64()) for f in RUN.fields])
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            rows = []
            for value in part.column(part.num_columns - 1):
                ids, words = words_of(value.as_py() or b"")
                runs = runs_of(ids, min_words, min_repeats)
                rows.append((len(ids), runs, best_run(runs), _collapse(ids, words, runs).decode("utf-8", "replace")))
            named = [[dict(zip(RUN.names, run, strict=True)) for run in row[1]] for row in rows]
            best = [row[2] and dict(zip(RUN.names, row[2], strict=True)) for row in rows]
            new = [pa.array([r[0] for r in rows], pa.int64()), pa.array(named, pa.list_(struct)), pa.array(best, struct), pa.array([r[3] for r in rows], pa.string())]
            names = [f"c{i}" for i in range(part.num_columns - 1)] + OUTPUT.names
            yield pa.RecordBatch.from_arrays(part.columns[:-1] + new, names=names)


def find_runs(docs: DataFrame, text_col: str | Column = "text", min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """docs with n_words, runs, best_run and collapsed; one pass, no shuffle. ``text_col``: a column of docs or an expression over them.

    ``min_repeats`` is at least 2: with fewer a stretch need not hold its period twice and smallest periods need not divide others.
    """
    if min_repeats < 2:
        raise ValueError("min_repeats must be at least 2")
    taken = {n.lower() for n in OUTPUT.names}
    keep = [c for c in docs.columns if c.lower() not in taken]
    text = F.col(f"`{text_col}`") if isinstance(text_col, str) else text_col
    # positional names inside the task: clashing or odd column names of the input cannot matter
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], text.cast("binary").alias("raw"))
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(inner.schema.fields[:-1])] + OUTPUT.fields)
    out = inner.mapInArrow(lambda it: _find_batches(it, min_words, min_repeats), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *OUTPUT.names)


def planted_text(doc_id: Column, text: Column) -> Column:
    """The contract's text: where h = crc32(doc_id as text) ends in 0, the words from a = floor(h/10) mod n on repeat the p words that start there.

    Other texts stay as they are; a null doc_id plants nothing.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def tail(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        places = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + F.pmod(i - a, p)).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), places), " ")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    bound = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(text))  # the words are split once
    return F.when(F.pmod(h, F.lit(10)) == 0, F.get(bound, 0)).otherwise(text)
