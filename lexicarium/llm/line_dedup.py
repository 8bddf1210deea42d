"""Line deduplication by overlapping three-line windows (operator 10; DataFrame functions only).

A text is cut at ``\\n``. Every three consecutive lines form a window; a window equal to one that
occurs earlier in the table is a later occurrence, and the lines that later occurrences cover,
merged into runs, are removed. "Earlier" orders by doc_id, then the text's hash, then position.

Defined results: null texts stay null with 0 lines; texts of fewer than three lines have no
window and stay as they are; windows of white space alone never count; rows that repeat both
doc_id and text are one document and are treated alike (the first occurrence stays in each);
null doc_ids come first in the order; an empty table gives an empty table. Clashing input
columns (``n_lines``, ``n_removed``) are replaced.

Plan: one pass hashes lines and windows (two independent 64-bit hashes) inside the scan; the
windows, 40 bytes each and without text, are pre-aggregated before the shuffle, so one window
that a third of the table holds is one row a task; only repeated windows are joined back (a broadcast
when they are counted to be at most 500,000 rows of 60 bytes, else a join that Spark splits where it is skewed), and the
runs found are gathered by document. Texts cross a shuffle once, to meet their runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicarium.llm.decontaminate import _sized, let
from lexicarium.llm.store import written

WINDOW_LINES = 3


def line_windows(docs: DataFrame, width: int = WINDOW_LINES) -> DataFrame:
    """(id, th, pos, a, b) of every window of ``width`` lines that holds a word."""
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(0x5EED), x).alias("b"), (F.length(F.trim(x)) > 0).alias("w")))

    def window(i: Column) -> Column:
        parts = [F.col("lines")[i + k] for k in range(width)]
        worded = parts[0]["w"]
        for p in parts[1:]:
            worded = worded | p["w"]
        return F.when(worded, F.struct(i.alias("pos"), F.xxhash64(*[p["a"] for p in parts]).alias("a"), F.xxhash64(*[p["b"] for p in parts]).alias("b")))

    starts = F.when(F.size("lines") >= width, F.sequence(F.lit(0), F.size("lines") - width)).otherwise(F.array().cast("array<int>"))
    return (
        docs.where(F.col("text").contains("\n"))
        .select("id", "th", lines.alias("lines"))
        # explode_outer: a plain explode infers filters that repeat the whole expression for every element
        .select("id", "th", F.explode_outer(F.transform(starts, window)).alias("w"))
        .where("w is not null")
        .select("id", "th", "w.pos", "w.a", "w.b")
    )


def removed_runs(windows: DataFrame, width: int = WINDOW_LINES) -> DataFrame:
    """(id, th, runs): per document the merged runs (first line, lines) that later occurrences cover, in order."""
    repeated = windows.groupBy("a", "b").agg(F.min(F.struct("id", "th", "pos")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("a").alias("ra"), F.col("b").alias("rb"), "first")
    is_first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th")) & (F.col("pos") == F.col("first.pos"))
    later = windows.join(_sized(written(repeated, "windows")), (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb"))).where(~is_first).select("id", "th", "pos").distinct()
    # islands: a start within reach of the previous one continues its run
    by_doc = Window.partitionBy("id", "th").orderBy("pos")
    opened = F.coalesce((F.col("pos") > F.lag("pos").over(by_doc) + width).cast("int"), F.lit(1))
    runs = later.select("*", opened.alias("o")).withColumn("run", F.sum("o").over(by_doc))
    runs = runs.groupBy("id", "th", "run").agg(F.min("pos").alias("start"), (F.max("pos") + width - F.min("pos")).alias("len"))
    return runs.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "len"))).alias("runs"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW_LINES) -> DataFrame:
    """docs with later occurrences of repeated windows removed from the text, plus n_lines and n_removed."""
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("th"))
    runs = removed_runs(line_windows(keyed.select("id", "th", "text"), width), width).select(F.col("id").alias("rid"), F.col("th").alias("rth"), "runs")
    joined = keyed.join(runs, F.col("id").eqNullSafe(F.col("rid")) & (F.col("th") == F.col("rth")), "left")
    # the kept stretches lie before each run and after the last: slices, not a test per line
    def stretch(lines: Column, k: Column) -> Column:
        start = F.when(k == 0, F.lit(0)).otherwise(F.get("runs", k - 1)["start"] + F.get("runs", k - 1)["len"])
        end = F.when(k == F.size("runs"), F.size(lines)).otherwise(F.get("runs", k)["start"])
        return F.slice(lines, start + 1, end - start)

    kept = let(F.split("text", "\n", -1), lambda lines: F.flatten(F.transform(F.sequence(F.lit(0), F.size("runs")), lambda k: stretch(lines, k))))
    gone = F.coalesce(F.aggregate("runs", F.lit(0), lambda s, r: s + r["len"]), F.lit(0))
    cleaned = F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.select(
        "row",
        cleaned.alias("cleaned"),
        F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"),
        gone.cast("long").alias("n_removed"),
    )
    return out.select(*[F.col("cleaned").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in keep], "n_lines", "n_removed")


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """docs with cleaned texts, docs' own columns only; size_col, where present, follows the text; documents of which no word is left go."""
    cleaned = dedup_lines(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))
    kept = cleaned.where((F.col("n_removed") == 0) | (F.length(F.trim(F.replace("text", F.lit("\n"), F.lit(" ")))) > 0))
    new = {text_col: F.col("text"), size_col: F.when(F.col("n_removed") == 0, F.col(f"row.`{size_col}`") if size_col in docs.columns else F.lit(None)).otherwise(F.length("text"))}
    return kept.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
