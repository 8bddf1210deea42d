"""Toxicity by multiple-instance learning (operator 8).

A document is a bag of sentences; instance scores p_s = sigmoid(b + sum of the weights of its distinct words) combine by
noisy-or, P = 1 - prod (1 - p_s), and only the document's label trains them. A word's weight is the
sum of hashed features: the word, its prefixes of 4 to 8 letters and its last 4 letters, so unseen
forms of a stem are scored too. The fitted sentence scores then locate the offending sentences.

Training reads a bounded sample: about ``TRAIN_TOXIC`` toxic and ``TRAIN_CLEAN`` other documents
with a label outside the held-out fold, chosen by a hash of doc_id (of rows that repeat an id the least
text). Tasks extract the features. Which ones are kept is screened first: a feature's number of toxic
documents must lie so many standard deviations from what its number of documents lets expect, as most
words of a corpus are too rare to teach anything and would only be learned by heart. That number, the
decay and the cut of the score are chosen by ``FOLDS`` folds inside the training rows; the driver gets
the kept features of the sample, never its texts. The fit is full-batch Adam.

Defined results: null or wordless texts score 0; several labels of one doc_id count as toxic if
any is; null labels teach nothing; without a toxic training document, or without a feature that passes, every
score is 0; repeated rows get equal scores; a null doc_id is scored and not held out; empty tables give empty results.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicarium.llm.store import delete, stored

TRAIN_TOXIC = 1_500
TRAIN_CLEAN = 3_000
SLOT_BITS = 18
EPOCHS = 150
RATE = 0.2
#: What the folds choose from: least deviations of a feature, and decay a training document.
LEAST_DEVIATIONS, DECAYS = (3.0, 4.0, 6.0), (1e-4, 3e-4)
FOLDS = 3
#: What a missed toxic document costs where the cut is chosen, in false alarms.
MISS_COST = 2
OFFENDING = 0.5
#: Texts of one-word "sentences" would be bags of thousands of instances whose small scores add up.
LEAST_WORDS = 8

_SENTENCE = re.compile(r"[^.!?\n。！？]+")
_WORD = re.compile(r"[^\W_]+")


def word_features(word: str) -> list[int]:
    parts = [f"w{word}", *(f"p{word[:k]}" for k in (4, 5, 6, 7, 8) if len(word) > k), *([f"s{word[-4:]}"] if len(word) > 4 else [])]
    return [xxhash.xxh32_intdigest(p) & ((1 << SLOT_BITS) - 1) for p in parts]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, distinct words) of the bag's instances: sentences, short ones joined with those that follow until LEAST_WORDS."""
    start, words = 0, []
    end = 0
    for m in _SENTENCE.finditer(text):
        found = _WORD.findall(m.group().lower())
        if not found:
            continue
        if not words:
            start = m.start()
        words += found
        end = m.end()
        if len(words) >= LEAST_WORDS:
            yield start, end, list(dict.fromkeys(words))
            words = []
    if words:
        yield start, end, list(dict.fromkeys(words))


class WordWeights(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        self[word] = w = float(self.weights[word_features(word)].sum())
        return w


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -z))


@dataclass
class Bags:
    """Training documents as kept features: ``doc`` of each instance; (``instance``, ``slot``, ``times``) of each feature of an instance; labels."""

    doc: np.ndarray
    instance: np.ndarray
    slot: np.ndarray
    times: np.ndarray
    toxic: np.ndarray

    def of(self, docs: np.ndarray) -> Bags:
        """The documents marked True, numbered anew."""
        keep = docs[self.doc]
        number = np.cumsum(keep) - 1
        own = keep[self.instance]
        return Bags((np.cumsum(docs) - 1)[self.doc[keep]], number[self.instance[own]], self.slot[own], self.times[own], self.toxic[docs])


def deviations(bags: Bags, n_slots: int) -> np.ndarray:
    """Per slot: how many standard deviations the toxic documents that hold it lie from what all that hold it let expect."""
    pairs = np.unique(bags.doc[bags.instance].astype(np.int64) * n_slots + bags.slot)
    doc, slot = pairs // n_slots, pairs % n_slots
    held = np.bincount(slot, minlength=n_slots)
    toxic = np.bincount(slot, weights=bags.toxic[doc], minlength=n_slots)
    return deviation(toxic, held, float(bags.toxic.sum()), len(bags.toxic))


def deviation(toxic, held, all_toxic: float, docs: int):
    share = all_toxic / max(1, docs)
    spread = np.sqrt(np.maximum(held * share * (1 - share) * (1 - held / (docs + 1)), 1e-9))
    return (toxic - held * share) / spread


def likelihood_and_slope(bags: Bags, weights: np.ndarray, intercept: float) -> tuple[float, np.ndarray, float]:
    """Negative log-likelihood of the documents' labels under noisy-or, and its slope in the weights and the intercept."""
    z = intercept + np.bincount(bags.instance, weights=weights[bags.slot] * bags.times, minlength=len(bags.doc))
    none = np.exp(-np.bincount(bags.doc, weights=_softplus(z), minlength=len(bags.toxic)))  # 1 - P
    some = np.maximum(1e-9, 1 - none)
    loss = -np.where(bags.toxic, np.log(some), np.log(np.maximum(none, 1e-300))).sum()
    g = np.where(bags.toxic, -none / some, 1.0)[bags.doc] * _sigmoid(z)
    return float(loss), np.bincount(bags.slot, weights=g[bags.instance] * bags.times, minlength=len(weights)), float(g.sum())


def fit(bags: Bags, n_slots: int, least: float, decay: float) -> tuple[np.ndarray, float]:
    """(weights, intercept) that maximise the likelihood less decay * weights^2 / 2 a document; slots of fewer deviations have no weight."""
    kept = np.abs(deviations(bags, n_slots)) >= least
    w, b = np.zeros(n_slots), -4.0
    m, v, mb, vb = np.zeros(n_slots), np.zeros(n_slots), 0.0, 0.0
    for step in range(1, EPOCHS + 1):
        _, gw, gb = likelihood_and_slope(bags, w, b)
        gw = np.where(kept, gw + decay * len(bags.toxic) * w, 0.0)
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        a, c = 1 - 0.9**step, 1 - 0.99**step
        w -= RATE * (m / a) / (np.sqrt(v / c) + 1e-6)
        b -= RATE * (mb / a) / (np.sqrt(vb / c) + 1e-6)
    return w, float(b)


def probabilities(bags: Bags, weights: np.ndarray, intercept: float) -> np.ndarray:
    z = intercept + np.bincount(bags.instance, weights=weights[bags.slot] * bags.times, minlength=len(bags.doc))
    return -np.expm1(-np.bincount(bags.doc, weights=_softplus(z), minlength=len(bags.toxic)))


def best_cut(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The cut in steps of 0.05 whose errors cost least, ties to the one nearest to 0.5."""
    cuts = np.arange(1, 20) / 20
    errors = [int((scores >= c)[~toxic].sum() + MISS_COST * (scores < c)[toxic].sum()) for c in cuts]
    return float(min(zip(errors, np.abs(cuts - 0.5), cuts, strict=True))[2])


def train(bags: Bags, n_slots: int, fold: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(weights, intercept, cut): deviations, decay and cut chosen where each document is scored by a fit that left its fold out."""
    tried = []
    for least in LEAST_DEVIATIONS:
        for decay in DECAYS:
            scores = np.zeros(len(bags.toxic))
            for k in np.unique(fold):
                inner = bags.of(fold != k)
                scores[fold == k] = probabilities(bags.of(fold == k), *fit(inner, n_slots, least, decay)) if inner.toxic.any() else 0.0
            sure = np.clip(np.where(bags.toxic, scores, 1 - scores), 1e-3, 1)  # a label that no text explains must not decide
            tried.append((float(np.log(sure).sum()), -least, -decay, best_cut(scores, bags.toxic)))
    _, least, decay, cut = max(tried)
    return *fit(bags, n_slots, -least, -decay), cut


def _features(batches: Iterable[pa.RecordBatch], kept) -> Iterator[pa.RecordBatch]:
    """(doc_id, y, instances, instance, slot, times): a training document's instances and their kept features (all without ``kept``)."""
    index = None if kept is None else {int(s): k for k, s in enumerate(kept.value)}
    for batch in batches:
        for row in batch.to_pylist():
            found = [(i, Counter(x for w in words for x in word_features(w))) for i, (_, _, words) in enumerate(sentences(row["text"]))]
            if not found:
                continue
            flat = [(i, s if index is None else index[s], n) for i, c in found for s, n in c.items() if index is None or s in index]
            columns = [[row["doc_id"]], [row["y"]], [len(found)], *([[x[k] for x in flat]] for k in range(3))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BAG_TYPES, strict=True)], names=_BAG_NAMES)


_BAG_TYPES = [pa.int64(), pa.bool_(), pa.int32(), *[pa.list_(pa.int32())] * 3]
_BAG_NAMES = ["doc_id", "y", "instances", "instance", "slot", "times"]
BAG = "doc_id long, y boolean, instances int, instance array<int>, slot array<int>, times array<int>"


def _learned(sample: DataFrame, all_toxic: int, docs: int) -> tuple[np.ndarray, float, float] | None:
    """(slot weights, intercept, cut) from a sample (doc_id, text, y), None if nothing can be learned."""
    spark = sample.sparkSession
    slots = sample.mapInArrow(lambda it: _features(it, None), BAG).select("y", F.explode(F.array_distinct("slot")).alias("slot"))
    counted = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("held"), F.count_if("y").alias("toxic")).where("held > 1").toArrow()  # at most 2^SLOT_BITS rows
    held, toxic = (np.asarray(counted.column(c), np.float64) for c in ("held", "toxic"))
    kept = np.sort(np.asarray(counted.column("slot"), np.int64)[np.abs(deviation(toxic, held, all_toxic, docs)) >= min(LEAST_DEVIATIONS) - 1])
    if not len(kept):
        return None
    shared = spark.sparkContext.broadcast(kept)
    rows = sample.mapInArrow(lambda it: _features(it, shared), BAG).toPandas().sort_values("doc_id", kind="stable")  # kept features of the sample
    y, instances = rows["y"].to_numpy(bool), rows["instances"].to_numpy(np.int64)
    if not y.any() or y.all():
        return None
    first = np.cumsum(instances) - instances
    joined = lambda c: np.concatenate([np.asarray(x, np.int64) for x in rows[c]])
    sizes = np.array([len(x) for x in rows["slot"]])
    bags = Bags(np.repeat(np.arange(len(y)), instances), joined("instance") + np.repeat(first, sizes), joined("slot"), joined("times"), y)
    fold = np.array([zlib.crc32(f"fold {d}".encode()) % FOLDS for d in rows["doc_id"]])
    weights, intercept, cut = train(bags, len(kept), fold)
    whole = np.zeros(1 << SLOT_BITS, np.float32)
    whole[kept] = weights
    return whole, intercept, cut


OUTPUT = "doc_id long, held_out boolean, score double, predicted int, offending array<struct<start: int, end: int, score: double>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _shown(p, cut: float):
    """A probability (or an array) moved in log-odds so that the cut stands at 0.5; 0 and 1 stay."""
    return p * (1 - cut) / (p * (1 - cut) + (1 - p) * cut)


def _score(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    fitted = pickle.loads(model.value)
    known = WordWeights(fitted[0]) if fitted else None
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            scores, spans = [], []
            for value in part.column("text"):
                text, spots, total = value.as_py(), [], 0.0
                if fitted and text:
                    if len(known) > 200_000:
                        known.clear()
                    found = list(sentences(text))
                    z = fitted[1] + np.array([sum(map(known.__getitem__, words)) for _, _, words in found])
                    total = float(_softplus(z).sum())
                    p = _shown(_sigmoid(z), fitted[2])
                    spots = [{"start": found[i][0], "end": found[i][1], "score": float(p[i])} for i in np.flatnonzero(p >= OFFENDING)]
                scores.append(_shown(min(1.0, max(0.0, -float(np.expm1(-total)))), fitted[2]) if fitted else 0.0)
                spans.append(spots)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(spans, _SPANS)],
                names=["doc_id", "held_out", "score", "predicted", "offending"],
            )


def score_documents(docs: DataFrame, labels: DataFrame, fold: int = 5, held_fold: int = 0, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted, offending), one row a row of docs."""
    part = lambda c: F.crc32(c.cast("string").cast("binary")) % fold
    marked = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y")).where((part(F.col("doc_id")) != held_fold) & F.col("y").isNotNull()).groupBy("doc_id").agg((F.max("y") > 0).alias("y"))
    n = {r.y: r.n for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("labels"), "doc_id"), 11) / F.lit(float(1 << 53))
    share = F.when(F.col("y"), F.lit(min(1.0, toxic / max(1, n.get(True, 0))))).otherwise(F.lit(min(1.0, clean / max(1, n.get(False, 0)))))
    chosen = F.broadcast(marked.where(draw < share))  # about toxic + clean rows, by the documented bound
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(part(F.col(f"`{id_col}`")) == held_fold, F.lit(False)).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    once = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where(F.col("text").rlike(r"\w"))
    sample = once.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))  # a text an id: about as many rows as were chosen
    model = None
    if n.get(True):
        table, path = stored(sample, "toxicity-sample")
        sizes = table.agg(F.count(F.lit(1)).alias("docs"), F.count_if("y").alias("toxic")).first()
        model = _learned(table, sizes.toxic, sizes.docs) if sizes.toxic else None
        delete(docs.sparkSession, path)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    return rows.mapInArrow(lambda it: _score(it, shared), OUTPUT)
