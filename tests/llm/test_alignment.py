"""The alignment sweep against a plain walk over direct encodings, and chunked encoding against whole texts."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexicarium.llm import alignment, queries, vocabularies
from lexicarium.llm.bpe import rank_bytes

A_PATH, B_PATH, WORD_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
SF = "/root/testdata/sf0.001"

a_plain = Tokenizer.from_file(A_PATH)
a_plain.encode_special_tokens = True
b_plain = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
word_plain = Tokenizer.from_file(WORD_PATH)
a_chunked = vocabularies.load(vocabularies.ByteVocabulary, rank_bytes(A_PATH))
b_chunked = vocabularies.load(vocabularies.PieceVocabulary, rank_bytes(B_PATH))
word_chunked = vocabularies.load(vocabularies.WordVocabulary, rank_bytes(WORD_PATH))

ODD = ["", " ", "  a", "a  ", "a\n\nb", "\n x", "x \n", "a\t b", "é ü", "中文 字", "日本語のテキスト", "<|endoftext|> <s> </s> <unk>", "a<|endoftext|>b", "don't  stop", "12 345", "\x1c a\x1fb",
       "▁ a▁b", "a\x85b", "　x", "é ́a", "  b", "x" * 300, "  \n \n  y", "᠎ z", "😀 👍🏽", "0\x00 1", "Straße ÀÉÎ çÇ×÷ ǅ Ǆ İı Ÿÿ ŁŐ'S É'll e\u0301é12é"]


def direct(text):
    """Ids of A and B with their token bytes, as the libraries give them."""
    a = a_plain.encode(" " + text, add_special_tokens=False).ids
    b = b_plain.encode(text)
    letters = vocabularies.byte_letters()
    a_bytes = [bytes(letters[c] for c in a_plain.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(b_plain.id_to_piece(i)[3:5], 16)]) if b_plain.is_byte(i) else b_plain.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return a, b, a_bytes, b_bytes


def agree(text):
    a, b, a_bytes, b_bytes = direct(text)
    spaced = (" " + text).encode()
    assert b"".join(a_bytes) == spaced and a_chunked.ids(text).tolist() == a
    found = b_chunked.ids(text)
    assert (found is None) == (b"".join(b_bytes) != spaced) and (found is None or found.tolist() == b)
    assert word_chunked.ids(text.encode()).tolist() == word_plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_chunks_encode_like_the_whole(text):
    agree(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t\r\x0b\x85  ▁́İab'stRE1,.-éÉ×ǅŸ中漢ßẞ한<|>😀")), max_size=40))
def test_chunks_encode_like_the_whole_generated(text):
    agree(text)


def test_chunks_encode_like_the_whole_documents(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        agree(r.text)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(vocabularies, "KEEP_CHUNKS", 3)
    memory = vocabularies.Memory(lambda new: [c.encode() for c in new])
    long = "x" * (vocabularies.KEEP_CHARS + 1)
    for chunks in ("ab", "abc", "cd", "e", ["f", long]):
        assert memory.of(list(chunks)) == [c.encode() for c in chunks] and len(memory.known) <= 3 and long not in memory.known


def plain_alignment(rows):
    """doc rows of the contract, by a walk over single tokens."""
    docs, counts = [], collections.Counter()
    for doc_id, text in rows:
        a, b, a_bytes, b_bytes = direct(text) if text else ([], [], [], [])
        if b"".join(a_bytes) != b"".join(b_bytes) or (text and b"".join(a_bytes) != (" " + text).encode()):
            a = b = []
        ends = lambda tokens: [sum(map(len, tokens[: i + 1])) for i in range(len(tokens))]
        ea, eb = ends(a_bytes) if a else [], ends(b_bytes) if b else []
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            gi, gj = ea.index(cut) + 1, eb.index(cut) + 1
            groups.append((a[i:gi], b[j:gj]))
            links.append((a[gi - 1], b[gj - 1]))
            i, j = gi, gj
        assert (i, j) == (len(a), len(b))
        docs.append((doc_id, len(a), len(b), groups, links))
        counts.update(links)
    most = collections.Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "hot"), [(16_384, 500_000), (64, 5), (7, 1)])
def test_alignment_equals_a_plain_walk(spark, window, hot):
    rng = random.Random(2)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect() if len(r.text) < 6000]
    rows = list(enumerate(ODD + texts + [" ".join(rng.choice(["the", "naïve", "tokenizer", "中文", "x\n"]) for _ in range(200))]))
    rows += [(5, None), (7, ODD[8]), (7, ODD[8]), (None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_", F.lit(1)).withColumn("n_a", F.lit("x")).withColumn("a.b", F.lit(2)).repartition(3)
    found = alignment.align(docs, A_PATH, B_PATH, window=window, hot_pairs=hot, held_links=50)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_alignment(rows)


def test_groups_spell_the_text(spark):
    text = "The naïve tokenizer, 中文 and more\nlines. " * 5
    rows = alignment.aligned_groups(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), A_PATH, B_PATH, window=32).orderBy("first_group").collect()
    assert {r.doc_id for r in rows} == {1} and len(rows) > 3
    at = 0
    for r in rows:
        assert r.first_group == at and len(r.a_ids) == len(r.b_ids)
        at += len(r.a_ids)
    for side, vocabulary in (("a_ids", a_chunked), ("b_ids", b_chunked)):
        assert b"".join(vocabulary.spell(ids) for r in rows for ids in r[side]) == (" " + text).encode()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A_PATH, B_PATH).count() == 0 and alignment.aligned_groups(docs, A_PATH, B_PATH).count() == 0


def test_query_equals_a_plain_walk(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect() if len(r.text) < 20_000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_alignment(rows)
    assert sorted(map(tuple, alignment.align(docs, queries.BYTES, queries.PIECES).collect()), key=repr) == expected
    assert queries.op13_alignment(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
