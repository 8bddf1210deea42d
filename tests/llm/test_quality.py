"""Quality rules: counts, fertility, bands and verdicts against plain versions."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexicarium.llm import quality
from lexicarium.llm.queries import PIECES, RANKS
from tests.llm.test_operators import AWKWARD, DOC, SF, docs_of, encoder, words

ENGLISH = "The committee met on Tuesday to discuss its annual budget, and members agreed that every school in the district should receive new books before winter. Roads near the river need repair after last month's storm, said an engineer, who expects work to begin once funds arrive from the state. Several parents asked for safer crossings; others wanted longer library hours and a garden behind the old town hall."


def plain_counts(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    wins = collections.Counter(zip(ws, ws[1:], ws[2:]))
    cover = {i + k for i in range(len(ws) - 2) if wins[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if any(w for w in re.split(r"[\x20\x09-\x0D]+", x)):
            dup += x in seen
            seen.add(x)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover)


def plain_fertility(text, ids, is_byte):
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    k = max(1, n // 64)
    cuts = [ids[64 * i : 64 * (i + 1) if i < k - 1 else n] for i in range(k)]
    shares = [sum(-c / len(w) * math.log2(c / len(w)) for c in collections.Counter(w).values()) / math.log2(len(w)) if len(w) > 1 else 0.0 for w in cuts]
    return n, len(text) / n, sum(map(bool, (is_byte[i] for i in ids))) / n, sum(shares) / k


def plain_verdicts(rows):
    """(kept, rejected_by) of each (text, lang), by plain loops over the whole table."""
    sp, is_byte = quality._processor(open(PIECES, "rb").read())
    enc = encoder()
    single = {enc.encode_single_token(bytes([b])): True for b in range(256)}
    measures, groups = [], collections.defaultdict(list)
    for text, lang in rows:
        n, *_, rep = plain_counts(text)
        t = text or ""
        p, r = plain_fertility(t, sp.encode(t), is_byte), plain_fertility(t, enc.encode_ordinary(t), collections.defaultdict(bool, single))
        script = quality.main_script(t)
        group = lang.strip(" ") if lang and lang.strip(" ") else script
        failed = n < 50 or 100 * rep > 50 * n
        measures.append((group, failed, [*p[1:], *r[1:]], p[0], r[0]))
        if not failed:
            groups[group].append((script, [*p[1:], *r[1:]]))
    out = []
    for group, failed, values, *tokens in measures:
        bad = []
        if not failed:
            n = len(groups[group])
            counted = collections.Counter(s for s, _ in groups[group])
            script = min(s for s in counted if counted[s] == max(counted.values()))
            for k, (name, low, high, share) in enumerate(quality.MEASURES):
                x = sorted(v[k] for _, v in groups[group])
                a, b = quality.PRIOR[script][k]
                q = [(n * x[max(0, math.ceil(p * n) - 1)] + quality.PRIOR_TEXTS * z) / (n + quality.PRIOR_TEXTS) for p, z in ((0.25, a), (0.5, (a + b) / 2), (0.75, b))]
                width = quality.FENCE * max(q[2] - q[0], quality.LEAST_SPREAD * q[1])
                slack = quality.NOISE * math.sqrt(q[1] * (1 - q[1]) / max(1, tokens[k // 3])) if share else 0
                if (low and values[k] < q[0] - width - slack) or (high and values[k] > q[2] + width + slack):
                    bad.append(name)
        out.append((not failed and not bad, bad))
    return out


@pytest.fixture(scope="module")
def mixed(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    junk = [" ".join(w + "$$$" for w in words(300, 2)), " | ".join(words(120, 3)), "一 " * 70]
    extra = docs_of(spark, [None, "", " \n ", "a b c a b c a b c", "é # * x y　z", "same\nsame\n\n \nsame", "the cat " * 60, ENGLISH, *junk])
    return d.unionByName(extra.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit(" ")).otherwise(F.lit(None).cast("string")))).unionByName(d.limit(3)).withColumn("Kept", F.lit("clash")).withColumn("a.b", F.lit(1))


def test_counts_and_verdicts_match_a_plain_version(spark, mixed):
    rows = quality.apply_quality(mixed, PIECES, RANKS).collect()
    assert len(rows) == mixed.count() and rows[0]["a.b"] == 1
    expect = plain_verdicts([(r.text, r.lang) for r in rows])
    for r, (kept, bad) in zip(rows, expect, strict=True):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert (r.kept, r.rejected_by) == (kept, bad)
    assert any(r.rejected_by for r in rows) and not any(r.base_failed and r.kept for r in rows)


def test_fertility_matches_a_plain_version():
    sp, is_byte = quality._processor(open(PIECES, "rb").read())
    texts = ["", "a", *AWKWARD, ENGLISH * 30]
    ids = [sp.encode(t) for t in texts]
    for text, i, got in zip(texts, ids, quality.fertility(texts, ids, is_byte), strict=True):
        assert np.allclose(got, plain_fertility(text, i, is_byte))
    assert quality.fertility([], [], is_byte) == []


@pytest.mark.parametrize("text", [*AWKWARD, "a  b   c " * 90, " x" * 200, ENGLISH * 3])
def test_pieces_of_a_long_text_tokenise_like_the_whole(text):
    sp, _ = quality._processor(open(PIECES, "rb").read())
    assert quality.piece_ids(sp, text, 40) == sp.encode(text)


def test_prose_stays_and_junk_goes(spark):
    junk = " ".join(w + "$$$" for w in words(300, 2)).upper()
    rows = quality.apply_quality(docs_of(spark, [ENGLISH, junk]).withColumn("kept", F.lit(1)), PIECES, RANKS).orderBy("doc_id").collect()
    assert rows[0].kept and not rows[1].kept and not rows[1].base_failed
    assert quality.main_script("Привет мир") == "Cyrillic" and quality.main_script("123") == "other"


def test_planted_junk_goes_and_clean_documents_stay(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = F.regexp_count("text", F.lit(r"[#*$%&|<>]")) / F.length("text") > 0.02
    rows = quality.apply_quality(d, PIECES, RANKS).where("not base_failed").select("kept", marks.alias("junk")).collect()
    junk, clean = [r.kept for r in rows if r.junk], [r.kept for r in rows if not r.junk]
    assert len(junk) > 30 and sum(junk) <= 0.03 * len(junk) and sum(clean) >= 0.99 * len(clean)


def test_edges(spark):
    assert quality.keep_good(docs_of(spark, []), PIECES, RANKS).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert quality.apply_quality(docs_of(spark, []), PIECES, RANKS).count() == 0
    d = spark.createDataFrame([(None, ENGLISH, None, None, None), (None, ENGLISH, None, None, None), (1, None, None, None, 0)], DOC)
    assert [r.kept for r in quality.apply_quality(d, PIECES, RANKS).orderBy("n_chars").collect()] == [True, True, False]
    assert quality.keep_good(d.drop("lang"), PIECES, RANKS).count() == 2
    long = ENGLISH + " " + " ".join(words(60_000, 5))
    assert quality.apply_quality(docs_of(spark, [long]), PIECES, RANKS).first().n_words == len(long.split())
