"""Benchmark decontamination by size-partitioned MinHash containment search (operator 2; DataFrame functions only).

Words are lower-cased runs of letters and digits; an item's or text's shingles are its distinct
runs of five words. An item leaks into a document when at least ``threshold`` (0.8) of its
shingles occur in the whole document.

Method. A short item inside a long document has a tiny Jaccard similarity, so MinHash over whole
documents would miss it. Items are partitioned by size instead: an item of n shingles is sketched
by its k least shingle hashes (bottom-k MinHash), k = n - ceil(threshold * n) + 1 following from n
alone, and the sketch is looked up among all shingle hashes of the document. A leak lacks at most
k - 1 of the item's shingles, so it holds at least one of any k of them, wherever they stand in the
document: every leak is a candidate, whatever the size of the item (items of under five shingles
have k = 1 and must be held whole).
Candidates are then verified: the exact share of the item's shingles (as strings) in the document.

Defined results: null or short texts (under five words) hold no shingle and match nothing, nor do
such items; empty tables give no pairs; rows that repeat doc_id and text give one pair; of rows
with equal doc_id and different texts the highest containment counts; null ids are kept as such.
Extra columns of either table are ignored by ``leaks`` and kept by ``drop_contaminated``.

Broadcasts: the item index only after its rows are counted (``BROADCAST_ROWS``, at most 48 MB);
beyond that both sides are shuffled on the hash. Candidate keys likewise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicarium.llm.store import written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: A joined side is broadcast up to this many rows, of under 100 bytes each, else shuffled.
BROADCAST_ROWS = 500_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once a row, whatever the optimizer does to the projection: a bound variable, not a column that could be substituted inside a lambda."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _starts(w: Column) -> Column:
    return F.when(F.size(w) >= SHINGLE_WORDS, F.sequence(F.lit(0), F.size(w) - SHINGLE_WORDS)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(text: Column) -> Column:
    return let(words(text), lambda w: F.transform(_starts(w), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE_WORDS)])))


def shingle_strings(text: Column) -> Column:
    """The distinct shingles of a text."""
    return let(words(text), lambda w: F.array_distinct(F.transform(_starts(w), lambda i: F.array_join(F.slice(w, i + 1, SHINGLE_WORDS), " "))))


def sketch_size(n: Column, threshold: float) -> Column:
    """Of how many shingles of an item of n at least one is in every document that holds threshold of them."""
    return F.greatest(n - F.ceil(F.lit(threshold) * n) + 1, F.lit(1)).cast("int")


def item_shingles(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, item_shingles, h, n_item) of the items that have shingles; equal items once."""
    return (
        benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.sort_array(shingle_strings(F.col(f"`{text_col}`"))).alias("item_shingles"), F.array_distinct(shingle_hashes(F.col(f"`{text_col}`"))).alias("h"))
        .where(F.size("item_shingles") > 0)
        .dropDuplicates(["item_id", "item_shingles"])
        .withColumn("n_item", F.size("item_shingles"))
    )


def _sized(df: DataFrame) -> DataFrame:
    """df, marked for broadcast when it is counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def leaks_by_key(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, item_id, n_item_shingles, n_matched) of every leak; th: the text's hash."""
    items = written(item_shingles(benchmark), "items")
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("th"), F.col(f"`{text_col}`").alias("text"))
    index = items.select("item_id", F.xxhash64("item_shingles").alias("ih"), F.explode(F.slice(F.sort_array("h"), F.lit(1), sketch_size(F.col("n_item"), threshold))).alias("m"))
    # explode_outer: a plain explode infers filters that compute its array again
    probes = keyed.select("id", "th", F.explode_outer(F.array_distinct(shingle_hashes(F.col("text")))).alias("m"))
    candidates = written(probes.join(_sized(index), "m").select("id", "th", "item_id", "ih").distinct(), "candidates")
    # verification: the exact containment of the candidates' whole texts
    few = candidates.select(F.col("id").alias("cid"), F.col("th").alias("cth"), F.col("item_id"), F.col("ih"))
    texts = keyed.join(_sized(few), F.col("id").eqNullSafe(F.col("cid")) & (F.col("th") == F.col("cth"))).select("id", "th", "text", "item_id", "ih")
    exact = items.select(F.col("item_id").alias("eid"), F.xxhash64("item_shingles").alias("eh"), "item_shingles", "n_item")
    both = texts.join(_sized(exact), F.col("item_id").eqNullSafe(F.col("eid")) & (F.col("ih") == F.col("eh")))
    counted = both.select("id", "th", "item_id", F.col("n_item").cast("long").alias("n_item_shingles"), F.size(F.array_intersect("item_shingles", shingle_strings(F.col("text")))).cast("long").alias("n_matched"))
    return counted.where(F.col("n_matched") >= F.lit(threshold) * F.col("n_item_shingles"))


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_matched, containment), one row a leaking pair."""
    best = leaks_by_key(docs, benchmark, threshold).groupBy(F.col("id").alias("doc_id"), "item_id").agg(F.max(F.struct((F.col("n_matched") / F.col("n_item_shingles")).alias("c"), "n_item_shingles", "n_matched")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_item_shingles", "b.n_matched", F.col("b.c").alias("containment"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that hold a benchmark item; all columns kept."""
    found = written(leaks_by_key(docs, benchmark, threshold).select(F.col("id").alias("leak_id_"), F.col("th").alias("leak_th_")).distinct(), "leaks")
    return docs.join(_sized(found), docs["doc_id"].eqNullSafe(found["leak_id_"]) & (F.xxhash64(docs["text"]) == found["leak_th_"]), "left_anti")
