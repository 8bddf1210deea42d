"""Order-dependent splits as parallel joins: running sums in two levels, the greedy byte-budget cut, and a check that nothing was lost.

Rows of a key stand in the order of ``at``, an integer from 0 up. Nothing here puts all rows of a key
into one task: sums run within blocks of ``BLOCK`` places, and only one row a block is summed over the
key; the greedy cut, which looks sequential, is followed by pointers that double their length a round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicarium.operators.tables import cut, drop

#: Places of ``at`` that one window task sums in order.
BLOCK = 65_536


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{c}__"]) for c in names])


def sums_before(rows: DataFrame, key: list[str], at: str, values: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """rows with a column per entry of ``values``: the sum of that value over the earlier rows of the key (0 for the first). Rows of one key and place count each other in no stated order."""
    marked = rows.withColumn("block__", F.floor(F.col(at) / block))
    for name, value in values.items():
        marked = marked.withColumn(f"v__{name}", value)
    within = Window.partitionBy(*key, "block__").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inner = marked
    for name in values:
        inner = inner.withColumn(name, F.coalesce(F.sum(f"v__{name}").over(within), F.lit(0)))
    sums = marked.groupBy(*key, "block__").agg(*[F.sum(f"v__{name}").alias(f"v__{name}") for name in values])
    earlier = Window.partitionBy(*key).orderBy("block__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"{c}__") for c in (*key, "block__")], *[F.coalesce(F.sum(f"v__{name}").over(earlier), F.lit(0)).alias(f"o__{name}") for name in values])
    out = inner.join(offsets, _same(inner, offsets, [*key, "block__"]))
    kept = [c for c in rows.columns if c not in values]
    return out.select(*kept, *[(F.col(name) + F.col(f"o__{name}")).alias(name) for name in values])


def greedy_batches(rows: DataFrame, key: list[str], at: str, size: Column, budget: int, frame: int = 2, between: int = 1, block: int = BLOCK) -> DataFrame:
    """rows' (key, at, batch): the greedy cut into consecutive batches of at most ``budget`` bytes, numbered from 0 within a key.

    A batch costs ``frame`` bytes and its rows' sizes plus ``between`` each, as a JSON array does with ``[``, ``]`` and commas
    (the last row pays one too, which is the rule). A row that does not fit alone has a batch to itself. ``at`` is unique in a key.

    Where the batch that begins with a row ends is a search in the running sums: as a batch spans at most one budget, the
    answer lies in one of two stretches of sums, so the search is a sort by stretch. The starts are then what the first row
    of a key reaches; each round doubles the steps, so rounds grow with the logarithm of the number of batches.
    """
    spark = rows.sparkSession
    cost = (size + F.lit(between)).cast("long")
    slim = rows.select(*key, F.col(at).cast("long").alias("at__"), cost.alias("cost__"))
    items, items_path = cut(sums_before(slim, key, "at__", {"i": F.lit(1).cast("long"), "s": F.col("cost__")}, block).withColumn("e", F.col("s") + F.col("cost__")))
    target = F.col("s") + F.lit(budget - frame)
    stretch = lambda value: F.floor(value / F.lit(budget))
    ends = items.select(*key, stretch(F.col("e")).alias("stretch"), F.col("e").alias("value"), F.lit(0).alias("asks"), "i")
    asks = items.select(*key, F.explode(F.array(stretch(target), stretch(target) - 1)).alias("stretch"), target.alias("value"), F.lit(1).alias("asks"), "i")
    upto = Window.partitionBy(*key, "stretch").orderBy("value", "asks").rowsBetween(Window.unboundedPreceding, 0)
    answered = ends.unionByName(asks).withColumn("last", F.max(F.when(F.col("asks") == 0, F.col("i"))).over(upto)).where("asks = 1")
    after = answered.groupBy(*key, "i").agg((F.greatest(F.max("last"), F.col("i")) + 1).alias("to"))
    total = items.groupBy(*key).agg(F.max("i").alias("most")).select(*[F.col(c).alias(f"{c}__") for c in key], "most")
    bounded = after.join(total, _same(after, total, key)) if key else after.crossJoin(total)  # one row
    jump, jump_path = cut(bounded.select(*key, "i", F.when(F.col("to") <= F.col("most"), F.col("to")).alias("to")))
    starts, starts_path = cut(items.where("i = 0").select(*key, "i"))
    while True:
        hop = jump.where("to is not null").select(*[F.col(c).alias(f"{c}__") for c in key], F.col("i").alias("i__"), F.col("to").alias("next"))
        reached = starts.join(hop, _same(starts, hop, [*key, "i"])).select(*key, F.col("next").alias("i"))
        if reached.isEmpty():
            break
        new, new_path = cut(starts.unionByName(reached))
        asked = jump.select(*key, F.col("i").alias("from"), F.col("to").alias("i"))
        longer, longer_path = cut(asked.join(hop, _same(asked, hop, [*key, "i"]), "left").select(*key, F.col("from").alias("i"), F.col("next").alias("to")))
        drop(spark, jump_path)
        drop(spark, starts_path)
        jump, jump_path, starts, starts_path = longer, longer_path, new, new_path
    first = starts.select(*[F.col(c).alias(f"{c}__") for c in key], F.col("i").alias("i__"), F.lit(1).alias("first"))
    marked = items.join(first, _same(items, first, [*key, "i"]), "left").select(*key, "at__", "i", F.coalesce("first", F.lit(0)).cast("long").alias("first"))
    numbered, path = cut(sums_before(marked, key, "i", {"before": F.col("first")}, block).select(*key, F.col("at__").alias(at), (F.col("before") + F.col("first") - 1).alias("batch")))
    for old in (items_path, jump_path, starts_path):
        drop(spark, old)
    return numbered


def batch_manifest(batched: DataFrame, key: list[str], at: str, content: Column) -> DataFrame:
    """Per batch: first and last place, rows, bytes and SHA-256 of its JSON array (one batch is one value: the budget bounds it)."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(at).alias("a"), content.alias("c")))), lambda x: x["c"])
    text = F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]"))
    return batched.groupBy(*key, "batch").agg(F.min(at).alias("first_index"), F.max(at).alias("last_index"), F.count(F.lit(1)).alias("items"), text.alias("text_")).select(*key, "batch", "first_index", "last_index", "items", F.octet_length("text_").cast("long").alias("bytes"), F.sha2("text_", 256).alias("sha256"))


def sequence_digest(rows: DataFrame, key: list[str], at: str, content: Column) -> DataFrame:
    """(key, items, digest): a digest of the contents and their places that adds up over tasks in any order.

    Each row's SHA-256 over its place and content is read as four numbers of 15 hexadecimal digits, and each is summed over the
    rows: equal sums mean equal rows at equal places, as far as SHA-256 tells them apart.
    """
    hashed = F.sha2(F.concat(F.col(at).cast("string"), F.lit(":"), content), 256)
    parts = [F.conv(F.substring(hashed, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)") for k in range(4)]
    sums = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("items"), *[F.sum(p).alias(f"p{k}") for k, p in enumerate(parts)])
    return sums.select(*key, "items", F.concat_ws("-", *[F.col(f"p{k}").cast("string") for k in range(4)]).alias("digest"))


def reconstruction(source: DataFrame, batches: DataFrame, key: list[str], at: str, content: str) -> DataFrame:
    """(key, items, found, complete): rows of the source, rows of its batches, and whether the batches hold the same contents at the same places."""
    a, b = sequence_digest(source, key, at, F.col(content)), sequence_digest(batches, key, at, F.col(content))
    b = b.select(*[F.col(c).alias(f"{c}__") for c in key], F.col("items").alias("found"), F.col("digest").alias("digest__"))
    joined = a.join(b, _same(a, b, key), "left")
    return joined.select(*key, "items", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce(F.col("digest") == F.col("digest__"), F.lit(False)).alias("complete"))


def concurrency(intervals: DataFrame, key: list[str], start: str, end: str, block: int = BLOCK) -> DataFrame:
    """(key, at, running): how many half-open intervals of a key run from each moment at which their number may change.

    A sweep line: starts count +1 and ends -1 at their moment (whole numbers, seconds for instance), changes of one moment are summed, and
    running sums are carried over blocks of ``block`` moments. Empty, reversed and open intervals (a null end) never run.
    """
    whole = intervals.where((F.col(start) < F.col(end)))
    moments = whole.select(*key, F.explode(F.array(F.struct(F.col(start).cast("long").alias("at"), F.lit(1).alias("change")), F.struct(F.col(end).cast("long").alias("at"), F.lit(-1).alias("change")))).alias("m"))
    changes = moments.groupBy(*key, F.col("m.at").alias("at")).agg(F.sum("m.change").alias("change"))
    swept = sums_before(changes, key, "at", {"before": F.col("change")}, block)
    return swept.select(*key, "at", (F.col("before") + F.col("change")).alias("running"))
