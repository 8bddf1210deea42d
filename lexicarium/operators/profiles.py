"""Observations of string values: character classes, Unicode blocks, entropy, block transitions, line structure; and the gate over them."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicarium import policy

#: Unicode blocks told apart, with first and last code point; anything else is "other".
BLOCKS = (
    ("basic_latin", 0x0000, 0x007F),
    ("latin_supplement", 0x0080, 0x00FF),
    ("latin_extended", 0x0100, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x04FF),
    ("general_punctuation", 0x2000, 0x206F),
    ("superscripts_subscripts", 0x2070, 0x209F),
    ("currency_symbols", 0x20A0, 0x20CF),
    ("letterlike_symbols", 0x2100, 0x214F),
    ("number_forms", 0x2150, 0x218F),
    ("arrows", 0x2190, 0x21FF),
    ("mathematical_operators", 0x2200, 0x22FF),
    ("misc_technical", 0x2300, 0x23FF),
    ("box_drawing", 0x2500, 0x257F),
    ("block_elements", 0x2580, 0x259F),
    ("geometric_shapes", 0x25A0, 0x25FF),
    ("misc_symbols", 0x2600, 0x26FF),
    ("dingbats", 0x2700, 0x27BF),
    ("misc_math_symbols_a", 0x27C0, 0x27EF),
    ("misc_math_symbols_b", 0x2980, 0x29FF),
    ("supplemental_math_operators", 0x2A00, 0x2AFF),
    ("cjk_symbols_punctuation", 0x3000, 0x303F),
    ("hiragana", 0x3040, 0x309F),
    ("katakana", 0x30A0, 0x30FF),
    ("bopomofo", 0x3100, 0x312F),
    ("cjk_extension_a", 0x3400, 0x4DBF),
    ("cjk_unified", 0x4E00, 0x9FFF),
    ("cjk_compatibility", 0xF900, 0xFAFF),
    ("cjk_compatibility_forms", 0xFE30, 0xFE4F),
    ("halfwidth_fullwidth", 0xFF00, 0xFFEF),
    ("misc_symbols_pictographs", 0x1F300, 0x1F5FF),
    ("emoticons", 0x1F600, 0x1F64F),
)
#: The entropy of a text looks at this many first characters, and the gate's entropy of a block at this many of the block's, by their definitions; ``entropy_by_block`` looks at all.
ENTROPY_WINDOW = 1024
#: A block with fewer characters has no entropy of its own.
LEAST_BLOCK = 10


def block_of(code: Column) -> Column:
    out = None
    for name, low, high in BLOCKS:
        test = code.between(low, high)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("other")


def occurrences(c: Column, characters: str) -> Column:
    """How many characters of a class stand in a text, without an array of them."""
    return F.length(c) - F.length(F.regexp_replace(c, f"{characters}+", ""))


def character_ratios(values: DataFrame) -> DataFrame:
    """Length and counts of digits, punctuation, control characters and paired symbols of every value, with their shares."""
    v, n = F.col("value"), F.length("value")
    counts = {"digits": r"\p{Nd}", "punctuation": r"\p{P}", "control": r"\p{Cc}", "control_other": r"[\p{Cc}&&[^\n\r\t]]", "brackets": r"[()\[\]{}]", "separators": "[,.:;=]"}
    out = values.select("asset_id", n.alias("n"), *[occurrences(v, p).alias(k) for k, p in counts.items()])
    return out.select("*", F.when(F.col("n") > 0, F.round(F.col("digits") / F.col("n"), 6)).otherwise(0.0).alias("digit_ratio"), F.when(F.col("n") > 0, F.round(F.col("punctuation") / F.col("n"), 6)).otherwise(0.0).alias("punctuation_ratio"))


def window_characters(values: DataFrame) -> DataFrame:
    """(asset_id, pos, ch) of the first characters."""
    return values.select("asset_id", F.posexplode(F.split(F.substring("value", 1, ENTROPY_WINDOW), "")).alias("pos", "ch")).where("ch <> ''")


def entropy(values: DataFrame) -> DataFrame:
    """(asset_id, entropy): Shannon entropy in bits of the first characters."""
    counts = window_characters(values).groupBy("asset_id", "ch").agg(F.count(F.lit(1)).alias("c"))
    # H = log2(n) - sum(c log2 c) / n, in one aggregation over the counts
    return counts.groupBy("asset_id").agg(F.round(F.log2(F.sum("c")) - F.sum(F.col("c") * F.log2("c")) / F.sum("c"), 6).alias("entropy"))


def block_distribution(values: DataFrame) -> DataFrame:
    """(asset_id, block, n, ratio) of all characters of every value."""
    every = F.sum("n").over(Window.partitionBy("asset_id"))  # every character is in one block
    return text_block_distribution(values).select("asset_id", "block", "n", F.round(F.col("n") / every, 6).alias("ratio"))


def block_transitions(values: DataFrame, top: int = 10) -> DataFrame:
    """(before, after, n): the commonest changes of block between neighbouring characters of whole values (a top report)."""
    return text_block_transitions(values, top)


@lru_cache(maxsize=1)
def _block_numbers() -> np.ndarray:
    """The number of each code point's block: its place in BLOCKS from 1 on, 0 for other."""
    out = np.zeros(0x110000, np.uint8)
    for k, (_, low, high) in enumerate(BLOCKS, 1):
        out[low : high + 1] = k
    return out


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _bits(codes: np.ndarray) -> float:
    """Shannon entropy."""
    c = np.unique(codes, return_counts=True)[1]
    return float(np.log2(len(codes)) - (c * np.log2(c)).sum() / len(codes)) if len(codes) else 0.0


def block_measures(values: DataFrame, window: int | None = None) -> DataFrame:
    """(asset_id, block, n, total, entropy), a row a value and block that it holds: characters in the block and in the value, and the entropy of the block's characters in the value (its first ``window`` if given), null below LEAST_BLOCK.

    The characters of a text are looked up in one table of blocks, so no row a character and no pass a block is made.
    """

    def measured(batches):
        names = ["other", *[b[0] for b in BLOCKS]]
        for batch in batches:
            rows = []
            for asset, value in zip(batch.column("asset_id"), batch.column("value")):
                if text := value.as_py():
                    codes = _code_points(text)
                    ids = _block_numbers()[codes]
                    counts = np.bincount(ids)
                    for k in np.flatnonzero(counts):
                        own = codes[ids == k][:window] if counts[k] >= LEAST_BLOCK else None
                        rows.append((asset.as_py(), names[k], int(counts[k]), len(codes), None if own is None else _bits(own)))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64()))], ["asset_id", "block", "n", "total", "entropy"])

    out = values.select("asset_id", "value").mapInArrow(measured, "asset_id string, block string, n long, total long, entropy double")
    return out.withColumn("entropy", F.round("entropy", 6))


def entropy_by_block(values: DataFrame) -> DataFrame:
    """(asset_id, block, n, entropy) of the blocks with LEAST_BLOCK characters or more; entropy of all of the block's characters in the value. Equal rows of an asset stand once."""
    return block_measures(values).where(F.col("n") >= LEAST_BLOCK).select("asset_id", "block", F.col("n").cast("int").alias("n"), "entropy").distinct()


def text_block_distribution(values: DataFrame) -> DataFrame:
    """(asset_id, block, n) of all characters; the blocks are counted in the text, without a row a character."""
    return block_measures(values).groupBy("asset_id", "block").agg(F.sum("n").alias("n"))


def text_block_transitions(values: DataFrame, top: int = 10) -> DataFrame:
    """(before, after, n): as ``block_transitions``, over whole texts; a run of one block becomes one private-use character first."""
    names = ["other", *[b[0] for b in BLOCKS]]
    span = [f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for _, lo, hi in BLOCKS]
    runs = F.regexp_replace("value", f"[^{''.join(span)}]+", chr(0xE000))
    for k, x in enumerate(span):
        runs = F.regexp_replace(runs, f"[{x}]+", chr(0xE001 + k))
    pairs = values.select(runs.alias("r")).select(F.explode(F.transform(F.sequence(F.lit(1), F.length("r")), lambda i: F.substring("r", i, F.lit(2)))).alias("p")).where(F.length("p") == 2)
    block = lambda at: F.get(F.array(*map(F.lit, names)), F.ascii(F.substring("p", at, 1)) - 0xE000)
    return pairs.groupBy("p").agg(F.count(F.lit(1)).alias("n")).select(block(1).alias("before"), block(2).alias("after"), "n").orderBy(F.desc("n"), "before", "after").limit(top)


def line_structure(values: DataFrame) -> DataFrame:
    """(asset_id, lines, blank, bullets, longest) of every value."""
    lines = F.split("value", "\n", -1)
    return values.select(
        "asset_id",
        F.size(lines).alias("lines"),
        F.size(F.filter(lines, lambda x: F.trim(x) == "")).alias("blank"),
        F.size(F.filter(lines, lambda x: x.rlike(r"^ *[-*•] "))).alias("bullets"),
        F.array_max(F.transform(lines, lambda x: F.length(x))).alias("longest"),
    )


def _moves():
    """A pandas UDF: how often the block changes in a text, and the entropy of its first ENTROPY_WINDOW characters."""

    @F.pandas_udf("steps long, bits double")
    def moves(values: pd.Series) -> pd.DataFrame:
        rows = []
        for text in values:
            codes = _code_points(text)
            rows.append((np.count_nonzero(np.diff(_block_numbers()[codes])), _bits(codes[:ENTROPY_WINDOW])))
        return pd.DataFrame(rows, columns=["steps", "bits"])

    return moves


def observations(values: DataFrame) -> DataFrame:
    """Per value: length, and structs of Unicode class shares, symbol totals, line structure and block transitions (whole values), and entropy (of the window)."""
    v, n = F.col("value"), F.length("value")
    share = lambda pattern: F.when(n > 0, occurrences(v, pattern) / n).otherwise(0.0)
    lines = F.split("value", "\n", -1)
    full = F.filter("ls_", lambda x: x.rlike(r"(?U)\S"))
    count = lambda test: F.size(F.filter("ls_", test))
    of_full = lambda k: F.when(F.size("full_") > 0, k / F.size("full_")).otherwise(0.0)
    wide = values.where("value is not null").select(
        "asset_id", "value", n.alias("n"), lines.alias("ls_"), _moves()(v).alias("moves_"),
        F.struct(share(r"[\x00-\x7f]").alias("ascii_ratio"), share(r"\p{Nd}").alias("digit_ratio"), share(r"\p{P}").alias("punct_ratio"), share(r"\p{Cc}").alias("control_ratio"), share(r"[\p{Cc}&&[^\n\r\t]]").alias("control_ratio_strict")).alias("unicode"),
        F.struct(occurrences(v, r"[()\[\]{}]").alias("paired_total"), occurrences(v, "[,.:;=]").alias("separators_total")).alias("symbols"),
    ).withColumn("full_", full)
    total = F.size("ls_")
    structure = F.struct(
        total.alias("total_lines"), (F.aggregate("ls_", F.lit(0).cast("long"), lambda s, x: s + F.length(x)) / total).alias("avg_line_length"), ((total - F.size("full_")) / total).alias("empty_line_ratio"),
        of_full(F.size(F.filter("full_", lambda x: x.rlike("^[ \t]")))).alias("indented_line_ratio"), (count(lambda x: x.rlike(r"[()\[\]{}]")) / total).alias("paired_symbol_line_ratio"),
        of_full(F.size(F.filter("full_", lambda x: F.length(F.regexp_replace(x, r"(?U)^\s+|\s+$", "")) <= 5))).alias("short_line_ratio"),
    )
    steps = F.col("moves_.steps").cast("int")
    moved = F.struct(steps.alias("transition_count"), F.when(F.col("n") > 1, steps / (F.col("n") - 1)).otherwise(0.0).alias("transition_density"))
    bits = F.struct(F.round("moves_.bits", 6).alias("avg"))
    return wide.select("asset_id", "n", "unicode", "symbols", structure.alias("line_structure"), moved.alias("block_transitions"), bits.alias("entropy"))


def with_blocks(observed: DataFrame, values: DataFrame) -> DataFrame:
    """observed with ``blocks``: an array of (block, ratio, entropy), entropy of the block's first ENTROPY_WINDOW characters, null below LEAST_BLOCK characters."""
    by = block_measures(values, ENTROPY_WINDOW).select("asset_id", "block", F.round(F.col("n") / F.col("total"), 6).alias("ratio"), "entropy").distinct()
    listed = by.groupBy(F.col("asset_id").alias("a_")).agg(F.array_sort(F.collect_list(F.struct("block", "ratio", "entropy"))).alias("blocks"))  # a few blocks a value
    return observed.join(listed, F.col("asset_id") == F.col("a_"), "left").drop("a_")


_COMPARE = {"gt": lambda a, b: a > b, "lt": lambda a, b: a < b, "ge": lambda a, b: a >= b, "le": lambda a, b: a <= b}
#: Rules that look at more than one observation: parameters -> Column.
COMPOSITES = {"dominant_block_low_entropy": lambda p: F.coalesce(F.exists("blocks", lambda b: (b["ratio"] >= p["share"]) & (b["entropy"] <= p["entropy"])), F.lit(False))}


def compared(metric: Column, op: str, threshold: float) -> Column:
    """The comparison; a missing metric compares as false."""
    return F.coalesce(_COMPARE[op](metric, F.lit(threshold)), F.lit(False))


def first_comparison(metric: Column, condition: dict) -> Column:
    """The condition's first known operator in the order gt, lt, ge, le; others are not looked at."""
    op = next((k for k in _COMPARE if k in condition), None)
    return compared(metric, op, condition[op]) if op else F.lit(False)


def evaluated(rule: dict, columns: list[str]) -> tuple[Column, Column, list[Column]]:
    """(triggered, missing, hits) of one resolved rule; hits: 'rule:metric' or null. Metrics whose column is not there count as missing."""
    if "composite" in rule:
        test = COMPOSITES[rule["composite"]](rule["params"]) if rule["composite"] in COMPOSITES else F.lit(False)
        return test, F.lit(False), [F.when(test, f"{rule['id']}:_composite:{rule['composite']}")]
    metric = lambda path: F.col(path) if path.split(".")[0] in columns else F.lit(None).cast("double")
    tests = {path: first_comparison(metric(path), condition) for path, condition in rule["when"].items()}
    absent = F.greatest(*[metric(path).isNull().cast("int") for path in tests], F.lit(0)) > 0
    hit = sum((t.cast("int") for t in tests.values()), F.lit(0))
    triggered = hit == len(tests) if rule.get("match", "any") == "all" else hit > 0
    return triggered, absent & ~triggered if rule.get("match", "any") == "all" else absent, [F.when(triggered & t, f"{rule['id']}:{path}") for path, t in tests.items()]


def eligibility(observed: DataFrame, rules: dict = policy.ELIGIBILITY) -> DataFrame:
    """(asset_id, decision, triggered): the gravest decision of the rules that hold; a protective ALLOW cancels DELAY, then a missing metric raises ALLOW to DELAY."""
    grave = {"ALLOW": 0, "DELAY": 1, "FREEZE": 2}
    worst, override, missing, hits = F.lit(grave[rules["default"]]), F.lit(False), F.lit(False), []
    for rule in rules["rules"]:
        if rule.get("decision") not in grave:
            continue
        triggered, absent, found = evaluated(policy.resolved(rule, rules["thresholds"]), observed.columns)
        missing, hits = missing | absent, hits + found
        if rule.get("override") and rule["decision"] == "ALLOW":
            override = override | triggered
        else:
            worst = F.greatest(worst, F.when(triggered, grave[rule["decision"]]).otherwise(0))
    worst = F.when(override & (worst == 1), 0).otherwise(worst)
    worst = F.when(missing, F.greatest(worst, F.lit(grave[rules["on_missing"]]))).otherwise(worst)
    return observed.select("asset_id", F.element_at(F.array(F.lit("ALLOW"), F.lit("DELAY"), F.lit("FREEZE")), worst + 1).alias("decision"), F.array_compact(F.array(*hits)).alias("triggered"))


def sampled_values(values: DataFrame, most: int = 200, most_chars: int = 8_000, total_chars: int = 2_000_000, seed: int = 42) -> DataFrame:
    """The values of each path that a profile samples (a sampling operator): in hash order, at most ``most`` of at most ``most_chars`` characters, until ``total_chars`` are read."""
    order = Window.partitionBy("path").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), "asset_id", F.col("value_index").cast("string"))), "asset_id")
    cut = values.where("value is not null").withColumn("chars", F.least(F.length("value"), F.lit(most_chars)))
    ranked = cut.withColumn("r_", F.row_number().over(order)).withColumn("before_", F.coalesce(F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranked.where((F.col("r_") <= most) & (F.col("before_") + F.col("chars") <= total_chars)).select("asset_id", "path", "value_index", "chars")
