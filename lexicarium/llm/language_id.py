"""Language identification by string kernels (operator 1).

Kernel: blended-spectrum n-gram presence. G(x) is the set of character n-grams (n = 1..4) of the
lower-cased text with runs of other characters than letters folded to one space; k(x, y) =
|G(x) & G(y)| / sqrt(|G(x)| |G(y)|). N-grams are hashed to ``2**HASH_BITS`` slots.

Nyström: ``LANDMARKS`` training texts a language span the feature map phi(x) = K_xL K_LL^(-1/2);
one-versus-rest kernel ridge regression is the ridge system of phi on 0/1 targets. Texts are scored
in batches: presence matrix (batch x landmark n-grams) times landmark matrix gives the kernel rows,
times the folded weights gives all languages' scores.

Training reads a bounded sample: about ``TRAIN_PER_LANG`` texts a language (at most ``TRAIN_TOTAL``
in all), chosen by a hash of doc_id among rows with non-null text and lang outside the held-out
fold. Landmarks and the ridge sums (landmarks squared) are the only things that reach the driver.

Defined results: null text or text without a letter is ``und`` with score 0; with nothing to learn
from every text is ``und``; ties between languages go to the first in sorted order; repeated rows
get equal answers; a null doc_id is predicted, not held out, never learned from; an empty table
gives an empty table. Whole texts are read, in slices of bounded size.
"""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDERS = (1, 2, 3, 4)
HASH_BITS = 16
LANDMARKS = 24
TRAIN_PER_LANG = 400
TRAIN_TOTAL = 8_000
MOST_LANDMARKS = 512
RIDGE = 1e-3
BATCH = 64
SLICE_CHARS = 1 << 18
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of every code point: 2 letter, 1 mark, 0 other."""
    kind = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c in "LM":
            kind[i] = 2 if c == "L" else 1
    return kind


def has_letter(text: str | None) -> bool:
    return bool(text) and bool((_kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")] == 2).any())


def folded_points(text: str) -> np.ndarray:
    """Code points of the lower-cased text; every run of others than letters and marks, and both ends, as one space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    word = _kinds()[points] > 0
    keep = word.copy()
    keep[0] = True
    keep[1:] |= word[:-1]
    return np.where(word, points, 32)[keep].astype(np.uint64)


def gram_slots(text: str, mark: np.ndarray) -> np.ndarray:
    """Sorted slots of the text's n-grams; mark: a zeroed boolean array of all slots, zeroed again after."""
    points = folded_points(text)
    longest = max(ORDERS)
    for at in range(0, len(points), SLICE_CHARS):
        part = points[at : at + SLICE_CHARS + longest - 1]  # slices overlap: no n-gram is cut
        h = np.zeros(len(part), np.uint64)
        for n in range(1, longest + 1):
            if len(part) < n:
                break
            h = h[: len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 :] + np.uint64(n)
            if n in ORDERS:
                mark[((h ^ (h >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - HASH_BITS)] = True
    slots = np.flatnonzero(mark)
    mark[slots] = False
    return slots


class Landmarks:
    """Landmark texts as a matrix over the slots that any of them has."""

    def __init__(self, texts: list[str]):
        mark = np.zeros(1 << HASH_BITS, bool)
        sets = [gram_slots(t, mark) for t in texts]
        used = np.unique(np.concatenate(sets))
        self.column = np.full(1 << HASH_BITS, -1, np.int32)
        self.column[used] = np.arange(len(used), dtype=np.int32)
        self.matrix = np.zeros((len(texts), len(used)), np.float32)
        for i, s in enumerate(sets):
            self.matrix[i, self.column[s]] = 1 / np.sqrt(len(s))

    def kernel(self, texts: list[str], mark: np.ndarray) -> np.ndarray:
        """k(text, landmark): one matrix product for the batch."""
        present = np.zeros((len(texts), self.matrix.shape[1]), np.float32)
        norms = np.empty(len(texts), np.float32)
        for i, t in enumerate(texts):
            slots = gram_slots(t, mark)
            at = self.column[slots]
            present[i, at[at >= 0]] = 1
            norms[i] = np.sqrt(len(slots))
        return (present @ self.matrix.T) / norms[:, None]


@lru_cache(maxsize=4)
def _loaded(blob: bytes):
    return pickle.loads(blob)


def _ridge_sums(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Partial sums of phi' phi and phi' y, one row a task."""
    marks, whiten, langs = _loaded(model.value)
    mark = np.zeros(1 << HASH_BITS, bool)
    place = {x: i for i, x in enumerate(langs)}
    rank = whiten.shape[1]
    gram, target, n = np.zeros((rank, rank)), np.zeros((rank, len(langs))), 0
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH).to_pydict()
            phi = marks.kernel(part["text"], mark).astype(np.float64) @ whiten
            y = np.zeros((len(phi), len(langs)))
            y[np.arange(len(phi)), [place[x] for x in part["lang"]]] = 1
            gram, target, n = gram + phi.T @ phi, target + phi.T @ y, n + len(phi)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((gram, target, n))], pa.binary())], names=["sums"])


def _predict(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    fitted = _loaded(model.value)
    mark = np.zeros(1 << HASH_BITS, bool)
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            texts = part.column("text").to_pylist()
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            some = [i for i, t in enumerate(texts) if has_letter(t)]
            if fitted is not None and some:
                marks, weights, langs = fitted
                scores = marks.kernel([texts[i] for i in some], mark).astype(np.float64) @ weights
                for i, row in zip(some, scores, strict=True):
                    best = int(row.argmax())
                    lang[i], score[i] = langs[best], float(min(1.0, max(0.0, row[best])))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])


def fit(train: DataFrame, per_lang: int = TRAIN_PER_LANG, landmarks: int = LANDMARKS, ridge: float = RIDGE):
    """(Landmarks, weights, languages) from train(doc_id, text, lang), or None when it holds nothing to learn from."""
    spark = train.sparkSession
    sizes = {r.lang: r.n for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not sizes:
        return None
    langs = sorted(sizes)
    per_lang = max(1, min(per_lang, TRAIN_TOTAL // len(langs)))
    landmarks = max(1, min(landmarks, MOST_LANDMARKS // len(langs), per_lang))
    # a hash of doc_id as a number from 0 to 1: rows below the language's share are the sample
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 11) / F.lit(float(1 << 53))
    share = lambda n: F.element_at(F.create_map(*[F.lit(v) for x in langs for v in (x, min(1.0, n / sizes[x]))]), F.col("lang"))
    drawn = train.withColumn("draw", draw)
    chosen = drawn.where(F.col("draw") < share(2.0 * landmarks)).select("lang", "draw", "text").collect()  # about 2 x landmarks texts a language
    by_lang = {x: sorted((r.draw, r.text) for r in chosen if r.lang == x)[:landmarks] for x in langs}
    texts = [t for x in langs for _, t in by_lang[x]]
    if not texts:
        return None
    marks = Landmarks(texts)
    between = marks.kernel(texts, np.zeros(1 << HASH_BITS, bool)).astype(np.float64)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    good = values > 1e-6 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    model = spark.sparkContext.broadcast(pickle.dumps((marks, whiten, langs)))
    sample = drawn.where(F.col("draw") < share(float(per_lang))).select("text", "lang").coalesce(24)
    rows = [pickle.loads(r.sums) for r in sample.mapInArrow(lambda it: _ridge_sums(it, model), "sums binary").collect()]  # 24 rows at most
    gram, target, n = (sum(r[i] for r in rows) for i in range(3))
    solved = np.linalg.solve(gram + ridge * max(1, n) * np.eye(len(gram)), target)
    return marks, whiten @ solved, langs


def identify(docs: DataFrame, fold: int = 4, held_fold: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row a row of docs."""
    part = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % fold
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(part == held_fold, F.lit(False)).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    train = docs.where((part != held_fold) & F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").rlike(r"\p{L}")).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(pickle.dumps(fit(train)))
    return rows.mapInArrow(lambda it: _predict(it, model), "doc_id long, held_out boolean, lang_pred string, score double")
