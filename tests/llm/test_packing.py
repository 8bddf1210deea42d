"""Packing: every token once, no sequence too long, few sequences, the plan against plain best fit."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexicarium.llm import packing, queries

WORDS = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
plain = Tokenizer.from_file(WORDS)


def encoded(text):
    return plain.encode(text or "", add_special_tokens=False).ids + [0]


def plain_best_fit(lengths, capacity):
    """Free space of each sequence, one piece at a time, longest first into the tightest sequence."""
    free = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, f in enumerate(free) if f >= length]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= length
        else:
            free.append(capacity - length)
    return free


def histograms():
    rng = random.Random(4)
    for capacity in (1, 2, 7, 30, 60):
        for n in (0, 1, 5, 200, 3000):
            skew = rng.choice([1, 2, 5])
            yield np.bincount([1 + int((capacity - 1) * rng.random() ** skew) for _ in range(n)], minlength=capacity + 1)
    yield np.bincount([40] * 1000 + [20] * 10 + [60] * 500, minlength=61)


def test_plan_holds_each_piece_once():
    for histogram in histograms():
        capacity = len(histogram) - 1
        shapes = packing.plan(histogram)
        held = np.zeros_like(histogram)
        for runs, count in shapes:
            assert count > 0 and sum(length * each for length, each in runs) <= capacity
            for length, each in runs:
                held[length] += each * count
        assert (held == histogram).all()
        bound = -(-int((np.arange(capacity + 1) * histogram).sum()) // capacity)
        sequences = sum(count for _, count in shapes)
        best = len(plain_best_fit(np.repeat(np.arange(capacity + 1), histogram), capacity))
        assert bound <= sequences <= best + max(2, best // 50)


def test_best_fit_by_lengths_equals_one_piece_at_a_time():
    for histogram in histograms():
        capacity = len(histogram) - 1
        shapes = packing.best_fit(histogram)
        free = sorted(capacity - sum(n * k for n, k in runs) for runs, count in shapes for _ in range(count))
        assert free == sorted(plain_best_fit(np.repeat(np.arange(capacity + 1), histogram), capacity))


def test_patterns_fill_the_capacity_and_the_fit_falls():
    histogram = np.bincount([5, 5, 9, 10, 10, 11, 14, 15, 19, 20, 25], minlength=31)
    shapes = packing.patterns(histogram)
    there = set(np.flatnonzero(histogram).tolist()) | {0}
    expected = {(a, b, 30 - a - b) for a in there for b in there if b and a <= b <= 30 - a - b and 30 - a - b in there}
    assert {tuple(s) for s in shapes.tolist()} == expected
    miss = lambda x: ((np.arange(31) * (np.bincount(shapes.ravel(), weights=np.repeat(x, 3), minlength=31) - histogram))[1:] ** 2).sum()
    x = packing.fitted(histogram, shapes, 2000)
    assert (x >= 0).all() and miss(x) < 0.5 * miss(np.zeros(len(shapes)))
    weight = (np.arange(31) ** 2 * (np.bincount(shapes.ravel(), weights=np.repeat(x, 3), minlength=31) - histogram)).astype(float)
    weight[0] = 0
    slope = weight[shapes].sum(axis=1)
    assert slope.min() > -1 and abs(slope[x > 1e-3]).max() < 1  # optimality: no descent, and none where a count is positive


def check(rows, docs, capacity):
    """rows of pack_documents against docs as (doc_id, text), and the number of sequences."""
    expected = sorted((d, k, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes())) for d, t in docs for ids in [encoded(t)] for k, at in enumerate(range(0, len(ids), capacity)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)  # gapless, no overlap
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= capacity
    return len(filled), -(-sum(r.length for r in rows) // capacity)


@pytest.mark.parametrize(("capacity", "rows"), [(2048, 500_000), (64, 0), (7, 0)])
def test_documents(spark, monkeypatch, capacity, rows):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", rows)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(-1, None), (-2, ""), (-3, " \n"), (-4, "x " * 5000), (-5, "same"), (-5, "same"), (-6, "a<|endoftext|>b ÀÉ Ｆ"), (-7, "word " * (capacity - 1))]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("piece", F.lit("x")).withColumn("length", F.lit(1)).withColumn("a.b", F.lit(2)).repartition(5)
    packed = packing.pack_documents(df, WORDS, capacity, keep_ids=True).cache()
    found, bound = check(packed.collect(), docs, capacity)
    assert bound <= found <= bound + max(2, bound // 20)
    whole = packing.sequences(packed).collect()
    assert len(whole) == found and all(len(r.token_ids) <= capacity for r in whole)
    assert sorted(i for r in whole for i in r.token_ids) == sorted(i for _, t in docs for i in encoded(t))


def test_null_id_and_empty_table(spark):
    one = packing.pack_documents(spark.createDataFrame([(None, None)], "doc_id long, text string"), WORDS).collect()
    assert [tuple(r) for r in one] == [(None, 0, 0, 1, zlib.crc32(b"\0\0\0\0"), 0, 0)]
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), WORDS).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op12_packing(spark, SF)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    sequences, bound = check(found.collect(), docs, 2048)
    assert sequences <= bound + 1
