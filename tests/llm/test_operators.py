"""Each operator on hand-made cases: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import collections
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

from lexicarium.llm import bpe, decontaminate, jaccard_join, language_id, line_dedup, lm_score, sharding, toxicity, warc
from lexicarium.llm.queries import RANKS
from lexicarium.llm.store import new_path

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in enumerate(texts)], DOC)


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


# --- 3: BPE ------------------------------------------------------------------------------------
def encoder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


AWKWARD = ["", " ", "a", "it's  the\n\n end ", "x" * 40_000, "ab 12'll " * 5_000, " \n\t" * 9_000, "é日本語 　\u0085\x1c" * 3_000, "a1" * 20_000, "don't" * 8_000, "<|endoftext|>", "\x00\x1f😀"]


@pytest.mark.parametrize("text", AWKWARD)
def test_pieces_tokenise_like_the_whole(text):
    enc = encoder()
    assert "".join(bpe.safe_pieces(text, 50)) == text
    assert [i for p in bpe.safe_pieces(text, 50) for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_bpe_rows(spark):
    enc = encoder()
    rows = bpe.encode_decode(docs_of(spark, [None, *AWKWARD]).withColumn("N_tokens", F.lit("clash")), RANKS).collect()
    assert len(rows) == len(AWKWARD) + 1
    for r in rows:
        ids = enc.encode_ordinary(r.text or "")
        assert r.token_ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encode_decode(docs_of(spark, []), RANKS).count() == 0


# --- 10: line dedup ----------------------------------------------------------------------------
def plain_line_dedup(rows):
    seen, out = {}, {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        if t is None:
            out[i, t] = None
            continue
        ls, gone = t.split("\n"), set()
        for p in range(len(ls) - 2):
            w = tuple(ls[p : p + 3])
            if any(x.strip(" ") for x in w) and seen.setdefault(w, (i, p)) != (i, p):
                gone |= {p, p + 1, p + 2}
        out[i, t] = "\n".join(x for p, x in enumerate(ls) if p not in gone)
    return out


def test_line_dedup(spark, table):
    texts = ["a\nb\nc\nd", "x\na\nb\nc\ny", "a\nb\nc\nd", "a\nb", "", None, "\n\n\n\n", "q\nq\nq\nq\nq", "\n".join(map(str, range(3000))), "k\n" + "\n".join(map(str, range(3000)))]
    d = docs_of(spark, texts)
    d = d.unionByName(d.where("doc_id = 1")).unionByName(spark.createDataFrame([(None, "x\na\nb\nc\ny", "en", "s", 0)], DOC)).unionByName(table.withColumn("doc_id", F.col("doc_id") + 100))
    expect = plain_line_dedup([(r.doc_id, r.text) for r in d.collect()])
    got = line_dedup.dedup_lines(d.withColumn("orig", F.col("text")).withColumn("N_Lines", F.lit("clash"))).collect()
    assert len(got) == d.count()
    for r in got:
        assert r.text == expect[r.doc_id, r.orig]
        assert r.n_removed == (0 if r.orig is None else len(r.orig.split("\n")) - (len(r.text.split("\n")) if r.n_removed < r.n_lines else 0))
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


# --- 2: decontamination ------------------------------------------------------------------------
def plain_leaks(docs, items, t=0.8):
    import regex

    def sh(x):
        w = [a for a in regex.split(r"[^\p{L}\p{N}]+", (x or "").lower()) if a]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    d, b = {i: sh(x) for i, x in docs}, {i: sh(x) for i, x in items}
    return {(i, j, len(y), len(x & y)) for i, x in d.items() for j, y in b.items() if y and len(x & y) >= t * len(y)}


def test_decontamination(spark, table):
    item = words(40, 5)
    long_doc = words(20_000, 6)
    texts = [" ".join(long_doc[:9_000] + item + long_doc[9_000:]), " ".join(item[:20]), " ".join(["X", *item[:34], "new", *item[34:]]).upper(), None, "", "one two", " ".join(long_doc)]
    d = docs_of(spark, texts).withColumn("item_id", F.lit("clash")).unionByName(table.withColumn("doc_id", F.col("doc_id") + 100).withColumn("item_id", F.lit("x")))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (1, " ".join(item))], "item_id long, text string").unionByName(spark.read.parquet(f"{SF}/benchmark.parquet").select((F.col("item_id") + 10).alias("item_id"), "text"))
    got = {tuple(r)[:4] for r in decontaminate.leaks(d, bench).collect()}
    expect = plain_leaks([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert got == expect and {(0, 1), (2, 1)} <= {g[:2] for g in got} and (1, 1) not in {g[:2] for g in got}
    kept = decontaminate.drop_contaminated(d, bench)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in d.collect()} - {e[0] for e in expect}
    assert decontaminate.leaks(d, bench.limit(0)).count() == 0 and decontaminate.leaks(d.limit(0), bench).count() == 0


def test_decontamination_finds_every_leak_of_short_items(spark):
    rng = random.Random(8)
    texts, items = [], []
    for k in range(600):  # items of 5 to 40 words, whole or with changed ends, in texts of 600 words
        item, body = words(rng.randint(5, 40 if k % 5 == 0 else 14), 1_000 + k), words(600, 9_000 + k)
        cut, at = rng.randint(0, (len(item) - 4) // 5), rng.randint(0, 600)
        texts.append(" ".join(body[:at] + item[: len(item) - cut] + body[at:]))
        items.append((k, " ".join(item)))
    for k, n in enumerate((20, 30, 40)):  # scattered: single runs of an item in all parts of a text
        item = words(n, 500 + k)
        texts.append(" ".join(w for i in range(n - 4) for w in item[i : i + 5] + words(300, 50_000 + i)))
        items.append((600 + k, " ".join(item)))
    expect = plain_leaks(list(enumerate(texts)), items)
    got = {tuple(r)[:4] for r in decontaminate.leaks(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(expect) > 500 and len(expect - got) == 0 and got == expect


# --- 4: Jaccard join ---------------------------------------------------------------------------
def plain_join(rows):
    known = jaccard_join.WordHashes()
    sets = [set(jaccard_join.shingle_set(t, known).tolist()) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and i >= 0.8 * (len(sets[a]) + len(sets[b]) - i):
                links[a] += 1
                links[b] += 1
                parent[max(top(a), top(b))] = min(top(a), top(b))
    least = collections.defaultdict(list)
    for i in range(len(rows)):
        least[top(i)].append(rows[i][0])
    return collections.Counter((rows[i][0], min(least[top(i)]), links[i]) for i in range(len(rows)))


@pytest.mark.parametrize("block", [256, 4])
def test_similarity_join(spark, table, block):
    base = words(200, 9)
    near = []
    for k in range(24):
        rng, w = random.Random(k), list(base)
        for _ in range(k % 6):
            w[rng.randrange(200)] = f"new{rng.random()}"
        near.append(" ".join(w))
    texts = [*near, near[0], near[0].upper(), None, "", "  ", "one two", "one two", "One  Two", "one two three"]
    d = docs_of(spark, texts).unionByName(table.limit(150).withColumn("doc_id", F.col("doc_id") + 100))
    got = collections.Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.similarity_join(d, block=block).collect())
    assert got == plain_join([(r.doc_id, r.text) for r in d.collect()])


def test_similarity_join_edges(spark):
    assert jaccard_join.similarity_join(docs_of(spark, [])).count() == 0
    d = docs_of(spark, ["a b c d e f", "a b c d e f", None, ""])
    d = d.unionByName(d.where("doc_id = 0")).unionByName(spark.createDataFrame([(None, "a b c d e f", "en", "s", 1), (0, "other words stand here entirely now", "en", "s", 1)], DOC))
    kept = jaccard_join.keep_one_of_each_class(d)
    assert kept.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(0, "a b c d e f"), (0, "other words stand here entirely now"), (2, None), (3, "")], key=str)


def test_close_copies_fold_into_balls(spark):
    texts = []
    for g, n in ((0, 60), (1, 50)):  # two groups of close copies, one of which drifts apart
        base = words(150, 70 + g)
        for k in range(n):
            rng, w = random.Random(100 * g + k), list(base)
            for _ in range(rng.randint(0, 2 + 4 * g)):
                w[rng.randrange(150)] = f"n{rng.random()}"
            texts.append(" ".join(w))
    texts += [t.upper() for t in texts[:7]] + [" ".join(words(40, 900 + k)) for k in range(30)]
    d = docs_of(spark, texts)
    got = collections.Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.similarity_join(d, block=8).collect())
    assert got == plain_join(list(enumerate(texts)))


def test_keep_one_of_each_class_takes_any_columns(spark):
    d = docs_of(spark, ["a b c d e f", "A b c d  e f", "x y z", None]).withColumn("stays_", F.lit(False)).withColumn("a.b", F.lit(1)).withColumn("node", F.lit("n")).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    kept = jaccard_join.keep_one_of_each_class(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]


def test_forest_levels_and_measured_recall(spark, table):
    known = jaccard_join.WordHashes()
    a = jaccard_join.trie_paths(jaccard_join.shingle_set(" ".join(words(60, 1)), known), 16)
    b = jaccard_join.trie_paths(jaccard_join.shingle_set(" ".join(words(60, 1)[1:]), known), 16)
    plain = max(next((k for k in range(5, 0, -1) if x >> (12 * (5 - k)) == y >> (12 * (5 - k))), 0) for x, y in zip(a.tolist(), b.tolist()))
    assert jaccard_join.met_at(a, b) == plain > 0 and jaccard_join.met_at(a, a) == 5
    base = [" ".join(w if i % 100 != k else f"v{k}" for i, w in enumerate(words(200, 11))) for k in range(20)]
    d = spark.createDataFrame([(100 * i, t, "en", "s", 0) for i, t in enumerate(base)], DOC)  # every id a query
    keyed = d.select("doc_id", F.unhex(F.md5("text")).alias("th"), "text")
    sample = jaccard_join.query_sample(keyed, 16)
    sets = [jaccard_join.shingle_set(t, known) for t in base]
    paths = [jaccard_join.trie_paths(s, 16) for s in sets]
    share = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    expect = collections.Counter(jaccard_join.met_at(paths[i], paths[j]) for i in range(20) for j in range(20) if i != j and share(sets[i], sets[j]) >= 0.8)
    found = collections.Counter()
    for s, p in zip(sets, paths, strict=True):
        hits = sample.hits(s, p, 0.8)
        found.update({k: int(n) for k, n in enumerate(hits if hits is not None else []) if n})
    assert found == expect and sum(found.values())
    assert {r.measured_recall for r in jaccard_join.similarity_join(d).collect()} == {1.0}
    assert {r.measured_recall for r in jaccard_join.similarity_join(d.where("doc_id = 0")).collect()} == {None}


def test_prefix_depth_meets_the_recall():
    k = jaccard_join.prefix_depth()
    assert 1 - (1 - 0.8**k) ** jaccard_join.TREES >= jaccard_join.TARGET_RECALL > 1 - (1 - 0.8 ** (k + 1)) ** jaccard_join.TREES


def test_connected_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    assert {r.node: r.component for r in jaccard_join.connected_components(edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- 5: LM scoring -----------------------------------------------------------------------------
def plain_automaton(texts, prior):
    """States as dictionaries: arcs, failure weight; one token after the other. Returns N and a function text -> (tokens, known, base, score)."""
    count, starts = collections.Counter(), 0
    for words_ in texts:
        history = ("<s>", *words_)
        starts += 1
        for i in range(1, len(history)):
            for k in range(3):
                if k <= i:
                    count[history[i - k : i + 1]] += 1
    n, v = sum(c for g, c in count.items() if len(g) == 1), sum(len(g) == 1 for g in count)
    count["<s>",] = starts
    states = {(): {}}
    for g in count:
        if len(g) > 1:
            states.setdefault(g[:-1], {})[g[-1]] = count[g]
    p0 = lambda w: (count[w,] * (w != "<s>") + 1) / (n + v + 1)

    def chance(h, w):
        if not h:
            return p0(w)
        return (states.get(h, {}).get(w, 0) + prior[len(h) - 1] * chance(h[1:], w)) / (count[h] + prior[len(h) - 1])

    def longest(h):
        while h and not count[h]:
            h = h[1:]
        return h

    def read(words_):
        state, score, base = longest(("<s>",)), 0.0, 0.0
        for w in words_:
            base += math.log10(p0(w))
            at = state
            while at and w not in states.get(at, {}):
                score += math.log10(prior[len(at) - 1] / (count[at] + prior[len(at) - 1]))
                at = at[1:]
            score += math.log10(chance(at, w))
            state = longest((*state, w)[-2:])
        return len(words_), sum(count[w,] > 0 for w in words_), base, score

    return n, read


@pytest.mark.parametrize("block_bytes", [60_000, 8 << 20])
def test_lm_score_matches_a_plain_automaton(spark, table, block_bytes):
    extra = [None, "", "A b\x0bC", "a b c " * 300, "é É", "a b c", "x a b"]
    d = table.unionByName(spark.createDataFrame([(1000 + i, t, "en", "s", 0) for i, t in enumerate(extra)], DOC))
    d = d.unionByName(d.where("doc_id = 3")).unionByName(spark.createDataFrame([(None, "a b c", "en", "s", 0)], DOC))
    rows = [(r.doc_id, r.text) for r in d.collect()]
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    n, read = plain_automaton([tokens(t) for i, t in rows if i is not None and not held(i)], lm_score.PRIOR_TOKENS)
    expect = collections.Counter()
    for i, t in rows:
        tok, known, base, score = read(tokens(t))
        expect[i, held(i), tok, known, n, round(base, 5), round(score, 5)] += 1
    got = collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in lm_score.score_corpus(d, block_bytes=block_bytes, slice_tokens=block_bytes // 100).collect())
    assert got == expect


def test_lm_score_edges(spark, table):
    assert lm_score.score_corpus(table.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "a b", "en", "s", 0)], DOC)  # nothing to learn from
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_score.score_corpus(alone).collect()] == [(0, 0, 0.0, 0.0)]


def test_lm_states_sum_to_one():
    texts = ["a b a c".split() + ["e"], "b a b".split() + ["e"]]
    count = lambda *g: sum(tuple(t[i : i + len(g)]) == g for t in (["<s>", *t] for t in texts) for i in range(len(t)))
    words_, n, v = ["a", "b", "c", "e", "?"], 9, 4
    for h in (("<s>",), ("a",), ("b", "a"), ("<s>", "b"), ("a", "b")):
        w = np.array([count(x) for x in words_], float)
        with np.errstate(divide="ignore"):
            total = 0.0
            for x, c in zip(words_, w, strict=True):
                counts = np.array([c, c]), np.array([0.0, count(h[-1], x)]), np.array([0.0, count(*h, x) if len(h) == 2 else 0.0])
                counts[0][0], counts[1][0] = (len(texts) if h[-1] == "<s>" else count(h[-1])), (count(*h) if len(h) == 2 else 0)
                total += 10 ** lm_score.traverse(*counts, np.array([0]), 2.0, n, v, (60.0, 5.0))[1][1]
        assert math.isclose(total, 1, rel_tol=1e-9)


# --- 1: language -------------------------------------------------------------------------------
def test_language_id_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)


def test_language_id_edges(spark):
    d = docs_of(spark, ["the and of the", "le la les des", None, "", "12 34 !!", "the " * 100_000]).withColumn("lang", F.when(F.col("doc_id") == 1, "fr").otherwise("en"))
    got = {r.doc_id: r for r in language_id.identify(d.withColumn("score", F.lit("clash"))).collect()}
    assert [got[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and got[2].score == 0
    assert language_id.identify(d.limit(0)).count() == 0
    assert {r.lang_pred for r in language_id.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- 8: toxicity -------------------------------------------------------------------------------
def test_toxicity_learns_from_documents_and_locates_sentences(spark):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(700):
        s = [" ".join(words(8, rng.random())) for _ in range(6)]
        if i % 4 == 0:
            s[i % 6] += " " + rng.choice(["vilethingen", "vilethingous", "horridoo"])
        texts.append(". ".join(s) + ".")
        labels.append((i, 1, int(i % 4 == 0)))
    d = docs_of(spark, [*texts, None, "", "..."])
    lab = spark.createDataFrame([*labels, (700, 1, None), (0, 0, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity.score_documents(d.withColumn("toxic", F.lit("clash")), lab).collect()}
    held = [i for i in range(700) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out for i in held) and sum(rows[i].predicted == labels[i][2] for i in held) / len(held) > 0.93
    hit = next(i for i in held if labels[i][2] and rows[i].predicted)
    assert any("vile" in texts[hit][s.start : s.end] or "horrid" in texts[hit][s.start : s.end] for s in rows[hit].offending)
    assert all(rows[i].score == 0 and rows[i].predicted == 0 for i in (700, 701, 702))
    assert {r.score for r in toxicity.score_documents(d, lab.limit(0)).collect()} == {0.0}
    assert toxicity.score_documents(d.limit(0), lab).count() == 0
    twice = d.where("doc_id < 300").union(d.where("doc_id < 300")).union(spark.createDataFrame([(None, texts[0], "en", "s", 1), (9_000, texts[0] * 400, "en", "s", 1)], DOC))
    again = toxicity.score_documents(twice, lab).collect()  # repeated rows teach once and score alike
    assert len(again) == 602 and all(len({r.score for r in again if r.doc_id == i}) == 1 for i in (0, 1, 4))
    loose = next(r for r in again if r.doc_id is None)
    assert not loose.held_out and loose.score == next(r.score for r in again if r.doc_id == 0)
    assert next(r for r in again if r.doc_id == 9_000).score >= loose.score


def test_toxicity_slope_and_screening_equal_plain_sums():
    rng = np.random.default_rng(2)
    doc = np.sort(rng.integers(0, 12, 30))
    bags = toxicity.Bags(doc, np.arange(30).repeat(3), rng.integers(0, 9, 90), rng.integers(1, 3, 90), rng.random(12) < 0.4)
    w, b = rng.normal(0, 0.5, 9), -1.0

    def plain(weights, intercept):
        total = 0.0
        for d in range(12):
            none = 1.0
            for i in np.flatnonzero(doc == d):
                z = intercept + sum(weights[s] * t for s, t in zip(bags.slot[bags.instance == i], bags.times[bags.instance == i], strict=True))
                none *= 1 - 1 / (1 + math.exp(-z))
            total -= math.log(max(1e-9, 1 - none)) if bags.toxic[d] else math.log(max(none, 1e-300))
        return total

    loss, slope, own = toxicity.likelihood_and_slope(bags, w, b)
    assert abs(loss - plain(w, b)) < 1e-9
    for k in range(9):
        step = np.eye(9)[k] * 1e-6
        assert abs(slope[k] - (plain(w + step, b) - plain(w - step, b)) / 2e-6) < 1e-4
    assert abs(own - (plain(w, b + 1e-6) - plain(w, b - 1e-6)) / 2e-6) < 1e-4
    for k, found in enumerate(toxicity.deviations(bags, 9)):
        docs = {d for d, s in zip(doc[bags.instance], bags.slot, strict=True) if s == k}
        share, n = bags.toxic.mean(), len(docs)
        spread = math.sqrt(max(n * share * (1 - share) * (1 - n / 13), 1e-9))
        assert abs(found - (sum(bags.toxic[d] for d in docs) - n * share) / spread) < 1e-9
    half = bags.of(np.arange(12) % 2 == 0)
    assert len(half.toxic) == 6 and half.doc.max() < 6 and (half.toxic == bags.toxic[::2]).all()
    full, part = toxicity.probabilities(bags, w, b), toxicity.probabilities(half, w, b)
    assert np.allclose(full[::2], part)
    assert toxicity.best_cut(np.array([0.1, 0.2, 0.6, 0.9]), np.array([False, False, True, True])) == 0.5
    assert toxicity.best_cut(np.array([0.1, 0.2, 0.31, 0.9]), np.array([False, False, True, True])) in (0.25, 0.3)
    assert toxicity._shown(0.3, 0.3) == 0.5 and toxicity._shown(0.0, 0.3) == 0 and toxicity._shown(1.0, 0.3) == 1


# --- 9: WARC -----------------------------------------------------------------------------------
PAGE = "page_id long, url string, html string"


def test_warc_round_trip(spark):
    big = "<p>é</p>" * 400
    rows = [(i, f"http://x/{i}", f"<html>{' '.join(words(80, i))}</html>") for i in range(60)]
    rows += [(100, "http://a\r\nb", big), (103, None, big), (101, "u", big), (103, None, big), (None, "n", big), (200, "s", "small"), (201, "s", "small"), (202, "z", None), (203, "z", "")]
    pages = spark.createDataFrame(rows, PAGE).withColumn("payload", F.lit("clash"))
    manifest = warc.write_archives(pages, new_path(spark, "warc"))
    got = warc.read_archives(manifest, payloads=True).collect()
    assert sum(r.records for r in manifest.collect()) == len(rows) == len(got)
    expect = collections.Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        again = len(p) >= 1000 and i != 103
        expect[i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", 103 if again else None, None if again else p] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == expect
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_reader_validates(tmp_path):
    record = warc.record_bytes(1, "u", b"payload", None)
    assert warc.parse_record(record)["payload"] == b"payload"
    for bad in (record.replace(b"WARC/1.1", b"WARC/9.9"), record[:-1], record.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"), record.replace(b"WARC-Type: response", b"WARC-Type response"), record.replace(b"Content-Length: 7", b"Content-Length: 8")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    samples = [warc.record_bytes(i, "u", ("<div class='page'><p>" + "</p><p>".join(words(300, i % 7) + words(60, i))).encode(), None) for i in range(300)]
    writer = warc.ArchiveWriter(f"file://{tmp_path}", warc.train_dictionary(samples))
    for s in samples:
        writer.add(s)
    uri, n, _ = writer.close()
    path = uri.removeprefix("file://")
    data = open(path, "rb").read()
    assert struct.unpack("<I", data[:4])[0] == warc.SKIPPABLE and n == 300 == len(list(warc.read_archive(uri)))
    open(path, "wb").write(data[:-5])
    with pytest.raises(ValueError):
        list(warc.read_archive(uri))


# --- 7: sharding -------------------------------------------------------------------------------
def test_sharding_keeps_every_row_and_versions(spark, table):
    t = sharding.ShardedTable(spark, new_path(spark, "table"))
    rows = table.unionByName(docs_of(spark, [None, "", "x"])).unionByName(table.limit(5)).withColumn("path", F.lit("clash")).withColumn("_metadata", F.lit("clash"))
    assert t.version() == 0 and t.compact(rows.schema) == 0
    assert t.append(rows, 20) == 1 and t.append(rows.limit(0), 20) == 2 and t.append(rows.limit(7), 3) == 3
    before = t.manifest().collect()
    version = t.compact(rows.schema, 400_000)
    after = t.manifest().collect()
    assert version == 4 == t.version() and len(after) < len(before)
    key = lambda df: sorted(map(str, df.collect()))
    whole = key(rows.unionByName(rows.limit(7)))
    assert key(t.read(rows.schema)) == whole == key(t.read(rows.schema, 3))
    assert sum(r.rows for r in after) == len(whole)
    with pytest.raises(Exception, match="exist"):
        t.commit(t.manifest(), 3)
    assert t.vacuum() > 0 and key(t.read(rows.schema)) == whole


def test_compaction_plans_by_tier():
    mb = 1 << 20
    assert sharding.planned([("a", 3 * mb, 3)], 64 * mb) == []  # three shards do not fill a tier
    assert sharding.planned([("a", 4 * mb, 4), ("b", 20 * mb, 1)], 64 * mb) == [["a"]]
    assert sharding.planned([("a", 200 * mb, 4), ("b", 64 * mb, 1)], 64 * mb) == []  # settled
    small = [(f"s{i}", mb // 2, 1) for i in range(4)]
    assert sharding.planned([*small, ("m", 6 * mb, 3)], 64 * mb) == [["m", "s0", "s1", "s2", "s3"]]  # what the first tier becomes fills the second
    assert [sharding.tier_of(x * mb) for x in (0.5, 1, 3.9, 4, 16, 63)] == [0, 1, 1, 2, 3, 3]


def test_shards_are_bounded_and_merges_pack_up_to_the_target(spark):
    t = sharding.ShardedTable(spark, new_path(spark, "table"))
    rows = spark.range(0, 6000, numPartitions=3).select("id", F.sha2(F.col("id").cast("string"), 512).alias("x"))
    for k, n in enumerate((4000, 1500, 400, 100)):
        t.append(rows.where(f"id >= {(0, 4000, 5500, 5900)[k]} and id < {(4000, 5500, 5900, 6000)[k]}"), 100)
        assert t.manifest().count() == k + 1
    before = t.shards().collect()
    assert max(r.rows for r in before) <= 100 and sum(r.rows for r in before) == 6000
    target = 150_000
    version = t.compact(rows.schema, target)
    after = t.shards().collect()
    whole = sum(r.bytes for r in before)
    plain, room = 0, 0  # next fit, largest first
    for size in sorted((r.bytes for r in before), reverse=True):
        plain, room = (plain, room - size) if size <= room else (plain + 1, target - size)
    assert version == 5 and len(after) == plain and whole / target <= plain <= 2 * whole / target + 1
    assert sorted(r.id for r in t.read(rows.schema).collect()) == list(range(6000))
    assert t.compact(rows.schema, target) == 5 or len(t.shards().collect()) <= len(after)
