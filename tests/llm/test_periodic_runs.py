"""Periodic runs against a brute-force search, and the contract's query against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexicarium.llm import periodic_runs as pr
from lexicarium.llm import queries

SF = "/root/testdata/sf0.001"


def smallest_period(x):
    return next(q for q in range(1, len(x) + 1) if all(x[i] == x[i + q] for i in range(len(x) - q)))


def plain_runs(x, min_words=24, min_repeats=3):
    """Every maximal stretch of every period, kept if no shorter period holds it."""
    found, n = [], len(x)
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_words, min_repeats * q) and smallest_period(x[i : i + length]) == q:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def cases():
    rng = random.Random(3)
    for n in (0, 1, 23, 24, 25, 60, 200):
        for letters in (1, 2, 3, 50):
            yield [rng.randrange(letters) for _ in range(n)]
    for _ in range(60):  # repeated blocks, nested and side by side
        x = []
        while len(x) < 150:
            block = [rng.randrange(4) for _ in range(rng.choice([1, 2, 3, 5, 8, 13]))]
            if rng.random() < 0.4:
                block = block * 4 + [rng.randrange(3)]
            x += block * rng.choice([1, 2, 3, 5, 9])
        yield x
    yield [0, 1] * 400 + [2] + [0, 1] * 400 + [0, 1, 2, 3] * 100  # frequent words take the transform


@pytest.mark.parametrize("shape", [(24, 3), (6, 2), (10, 4)])
def test_runs_equal_brute_force(shape):
    for x in cases():
        assert pr.runs_of(np.array(x, np.int32), *shape) == plain_runs(x, *shape), x


def test_lag_counts_equal_all_pairs():
    rng = random.Random(5)
    x = np.array([0 if rng.random() < 0.5 else int(rng.paretovariate(0.6)) for _ in range(900)]) % 300
    plain = [0] + [int((x[q:] == x[:-q]).sum()) for q in range(1, 301)]
    assert np.abs(pr.lag_matches(x, 300) - plain).max() < 1e-6


def test_long_repetitive_texts_stay_cheap():
    n = 200_000
    assert pr.runs_of(np.zeros(n, np.int32)) == [(0, n, 1)]
    x = np.random.default_rng(1).integers(0, 2, n).astype(np.int32)
    x[50_000:110_000] = x[50_000:60_000].tolist() * 6
    runs = pr.runs_of(x)
    start, length, period = max(runs, key=lambda r: r[1])
    assert period == 10_000 and start <= 50_000 and start + length >= 110_000 and length < 60_100


def test_words_are_cut_the_same_in_stretches(monkeypatch):
    raw = "a  b\tc\x0bd\x1ce f \n g".encode() * 40
    whole = pr.words_of(raw)
    monkeypatch.setattr(pr, "STRETCH_BYTES", 7)
    ids, words = pr.words_of(raw)
    assert words == whole[1] and ids.tolist() == whole[0].tolist() and [words[i] for i in ids.tolist()] == re.findall(rb"[^\x20\x09-\x0D]+", raw)


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = pr.runs_of(np.unique(words, return_inverse=True)[1] if n else np.zeros(0, int))
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_equals_plain_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op11_periodic_runs(spark, SF)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((plain_row(*d) for d in docs), key=repr)


def test_edges(spark):
    text = "x " + "la li lu " * 20 + "y"
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t", "c"), (4, text, "d"), (4, text, "d"), (None, text, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `RUNS` string").withColumn("a.b", F.lit(1)).withColumn("raw", F.lit(2)).withColumn("c0", F.lit(3))
    got = pr.find_runs(docs)
    assert got.columns == ["doc_id", "text", "a.b", "raw", "c0", "n_words", "runs", "best_run", "collapsed"]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()]
    assert got[:3] == [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], "")]
    assert got[3] == got[4] == (4, 62, [(1, 60, 3)], "x la li lu y") and got[5][1:] == got[3][1:]
    assert pr.find_runs(docs.limit(0)).count() == 0
    planted = docs.select(pr.planted_text(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert planted[0].t is None and planted[1].t == "" and planted[5].t == text
    with pytest.raises(ValueError):
        pr.find_runs(docs, min_repeats=1)
