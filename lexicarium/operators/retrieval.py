"""Retrieval: bi-temporal annotation queries, current revisions, text search, vectors, paging and budgets, vector-store audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def annotations_of(events: DataFrame) -> DataFrame:
    """events as bi-temporal annotations; each supersedes the same user's previous one of its type."""
    chain = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    return events.select(F.col("event_id").alias("annotation_id"), F.col("user_id").alias("anchor_id"), F.col("ts").alias("event_time"), (F.col("ts") + F.expr("interval 1 hour")).alias("ingested_at"), F.col("event_type").alias("annotation_type"), F.col("props").alias("body"), F.lag("event_id").over(chain).alias("supersedes"))


def selected(annotations: DataFrame, types: list[str] | None = None, start: str | None = None, end: str | None = None, as_of: str | None = None) -> DataFrame:
    """Filters that reach the scan: types, half-open event time, and what was known at ``as_of``."""
    out = annotations
    if types:
        out = out.where(F.col("annotation_type").isin(types))
    if start:
        out = out.where(F.col("event_time") >= F.lit(start).cast("timestamp"))
    if end:
        out = out.where(F.col("event_time") < F.lit(end).cast("timestamp"))
    if as_of:
        out = out.where((F.col("event_time") <= F.lit(as_of).cast("timestamp")) & (F.col("ingested_at") <= F.lit(as_of).cast("timestamp")))
    return out


def current_revisions(annotations: DataFrame) -> DataFrame:
    """Annotations that no other one of the given rows supersedes; give rows known at a time for the revision current then."""
    newer = annotations.where("supersedes is not null").select(F.col("supersedes").alias("old_")).distinct()
    return annotations.join(newer, F.col("annotation_id") == F.col("old_"), "left_anti")


def conflicts(annotations: DataFrame) -> DataFrame:
    """(supersedes, n): revisions that more than one other supersedes."""
    return annotations.where("supersedes is not null").groupBy("supersedes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def page(rows: DataFrame, order: list, size: int = 100, offset: int = 0) -> DataFrame:
    """One row more than ``size`` is looked at: has_more says whether another page follows."""
    taken = rows.orderBy(*order).offset(offset).limit(size + 1).withColumn("n_", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))).withColumn("r_", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)))
    return taken.where(F.col("r_") <= size).withColumn("has_more", F.col("n_") > size).drop("n_", "r_")


def within_bytes(rows: DataFrame, text_col: str, group: list[str], order: list, budget: int) -> DataFrame:
    """Leading rows of each group, in order, while their text fits the byte budget."""
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("bytes_", F.sum(F.octet_length(text_col)).over(upto)).where(F.col("bytes_") <= budget).drop("bytes_")


def containing(rows: DataFrame, text_col: str, query: str) -> DataFrame:
    """Rows whose text holds the query, letter case aside; % and _ are plain characters."""
    return rows.where(F.lower(text_col).contains(query.lower()))


def cosine_distance(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return 1 - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, query: list[float], n: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, distance): the n vectors nearest to the query by cosine distance; a top-n, so only n rows a task are kept."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.select(id_col, F.round(cosine_distance(F.col(vector_col), q), 6).alias("distance")).orderBy("distance", id_col).limit(n)


def vector_problems(vectors: DataFrame, dimension: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, problem): vectors of another dimension, or with a value that is not finite, or null."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    problem = F.when(v.isNull(), "missing").when(F.size(v) != dimension, "dimension").when(~finite, "not_finite")
    return vectors.select(id_col, problem.alias("problem")).where("problem is not null")


def embedding_signature(fields: dict[str, Column]) -> Column:
    """SHA-256 of the sorted key=value pairs; null or empty values as NULL."""
    pairs = [F.concat(F.lit(f"{k}="), F.coalesce(F.nullif(fields[k].cast("string"), F.lit("")), F.lit("NULL"))) for k in sorted(fields)]
    return F.sha2(F.concat_ws("|", *pairs), 256)


def lifecycle(records: DataFrame, index: DataFrame) -> DataFrame:
    """(object_id, state): active for a new object, duplicate for an equal signature, replace for another."""
    joined = records.join(index.select("object_id", F.col("signature").alias("active_")), "object_id", "left")
    return joined.select("object_id", F.when(F.col("active_").isNull(), "active").when(F.col("active_") == F.col("signature"), "duplicate").otherwise("replace").alias("state"))


def store_differences(sql: DataFrame, store: DataFrame) -> DataFrame:
    """(kind, n): ids of one store only (orphan, missing) and ids whose signatures differ (drift), by one full outer join."""
    both = sql.select("object_id", F.col("signature").alias("a")).join(store.select("object_id", F.col("signature").alias("b")), "object_id", "full")
    kind = F.when(F.col("a").isNull(), "orphan").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "drift")
    return both.select(kind.alias("kind")).where("kind is not null").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def hybrid(hits: DataFrame, structured: DataFrame) -> DataFrame:
    """Vector hits that the structured query also has, in the order of their distance."""
    return hits.join(structured, hits.columns[0], "left_semi").orderBy("distance", hits.columns[0])


def failures(annotations: DataFrame, status_col: str, statuses: list[str], decision_col: str, decisions: list[str]) -> DataFrame:
    """What failure learning looks at: a failing status or a rejecting decision."""
    return annotations.where(F.coalesce(F.col(status_col).isin(statuses), F.lit(False)) | F.coalesce(F.col(decision_col).isin(decisions), F.lit(False)))


def json_search(rows: DataFrame, json_col: str, path: str, query: str) -> DataFrame:
    """Rows whose JSON value at ``path`` holds the query, letter case aside; % and _ are plain characters."""
    return rows.where(F.lower(F.get_json_object(json_col, path)).contains(query.lower()))


def with_conflicts(annotations: DataFrame) -> DataFrame:
    """annotations with ``branches``: how many supersede the same one, null where only this one does."""
    return annotations.join(conflicts(annotations).select(F.col("supersedes").alias("s_"), F.col("n").alias("branches")), F.col("supersedes") == F.col("s_"), "left").drop("s_")


def appended(requests: DataFrame, receipts: DataFrame, key: list[str], payload: Column) -> DataFrame:
    """requests with ``outcome``: inserted, duplicate (a receipt of equal key and content) or conflict (equal key, other content); within the requests the first of a key counts as its receipt."""
    hashed = requests.withColumn("content_hash", F.sha2(payload, 256))
    known = receipts.select(*[F.col(k).alias(f"{k}_") for k in key], F.col("content_hash").alias("known_"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    own = Window.partitionBy(*key).orderBy("request_at", "content_hash")
    joined = hashed.withColumn("first_", F.first("content_hash").over(own)).withColumn("place_", F.row_number().over(own)).join(known, same, "left")
    held = F.coalesce("known_", F.when(F.col("place_") > 1, F.col("first_")))
    outcome = F.when(held.isNull(), "inserted").when(held == F.col("content_hash"), "duplicate").otherwise("conflict")
    return joined.withColumn("outcome", outcome).drop("first_", "place_", "known_", *[f"{k}_" for k in key])


def episodes(annotations: DataFrame, key: list[str], slot_col: str, required: list[str], failing: list[str]) -> DataFrame:
    """Per key an episode: members a slot, missing and contested slots, completeness, and the reasons that speak against using it; one aggregation."""
    slots = annotations.groupBy(*key, slot_col).agg(F.count(F.lit(1)).alias("n"))
    held = F.sort_array(F.collect_set(slot_col))  # a few slots an episode
    out = slots.groupBy(*key).agg(F.sum("n").alias("members"), held.alias("slots"), F.sort_array(F.collect_set(F.when(F.col("n") > 1, F.col(slot_col)))).alias("contested"))
    missing = F.sort_array(F.array_except(F.array(*[F.lit(x) for x in required]), "slots"))
    out = out.withColumn("missing", missing).withColumn("completeness", F.when(F.size("missing") == 0, "complete").otherwise("incomplete"))
    failed = F.arrays_overlap("slots", F.array(*[F.lit(x) for x in failing]))
    reasons = F.array_compact(F.array(F.when(F.size("missing") > 0, "incomplete"), F.when(F.size("contested") > 0, "snapshot_conflict"), F.when(failed, "failure_counterexample")))
    return out.withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


def packed(rows: DataFrame, text_col: str, group: str, order: list[str], budget: int) -> DataFrame:
    """Rows of each group, in order, that fit what is left of the byte budget; rows that do not are skipped, later ones may fit.

    What is chosen depends on all choices before it, so the sizes (not the texts) of a group are streamed in order through one task.
    """
    small = rows.select(F.col(group).alias("g"), *order, F.octet_length(text_col).cast("long").alias("size")).where(F.col("size") <= budget)
    names = [f for f in small.schema.fields if f.name != "size"]

    def choose(batches):
        now, left = None, budget
        for batch in batches:
            keep = []
            for g, size in zip(batch["g"], batch["size"], strict=True):
                if now is None or g != now[0]:
                    now, left = (g,), budget
                keep.append(size <= left)
                left -= size if keep[-1] else 0
            yield batch.loc[keep, [f.name for f in names]]

    chosen = small.repartition("g").sortWithinPartitions("g", *order).mapInPandas(choose, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names))
    return chosen.withColumnRenamed("g", group)


def latest_by(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in order; one aggregation."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*")


def nearest_to_each(queries: DataFrame, vectors: DataFrame, n: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", blocks: int = 16) -> DataFrame:
    """(query_id, id, distance, rank): the n nearest vectors of every query, itself left out, exactly.

    Queries are packed into ``blocks`` arrays that are broadcast (a query set counted to be small; beyond that call it in parts), each task keeps the n best of its rows for
    every query, so what is shuffled is tasks x queries x n rows, not pairs.
    """
    import numpy as np
    import pandas as pd

    count = queries.limit(100_001).count()
    if count > 100_000:
        raise ValueError("more than 100,000 queries: pass them in parts")
    found = queries.select(id_col, vector_col).orderBy(id_col).toArrow()  # counted above
    ids = np.array(found.column(id_col).to_pylist(), np.int64)
    q = np.array(found.column(vector_col).to_pylist(), np.float64).reshape(len(ids), -1)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, q / np.linalg.norm(q, axis=1, keepdims=True) if len(ids) else q))

    def best(batches):
        qid, qv = shared.value
        held_id, held = np.full((len(qid), n), -1, np.int64), np.full((len(qid), n), np.inf)
        for batch in batches:
            for first in range(0, len(batch), 1024):  # blocks of 1,024 rows and 256 queries: what a task holds does not grow with its batch
                rows = batch.iloc[first : first + 1024]
                v = np.array(rows[vector_col].tolist(), np.float64)
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                mine = rows[id_col].to_numpy(np.int64)
                for at in range(0, len(qid), 256):
                    part = slice(at, at + 256)
                    d = np.round(1 - qv[part] @ v.T, 9)
                    d[qid[part][:, None] == mine[None, :]] = np.inf
                    both, who = np.hstack([held[part], d]), np.hstack([held_id[part], np.broadcast_to(mine, d.shape)])
                    order = np.lexsort((who, both), axis=1)[:, :n]
                    held[part], held_id[part] = np.take_along_axis(both, order, 1), np.take_along_axis(who, order, 1)
        keep = np.isfinite(held)
        yield pd.DataFrame({"query_id": np.repeat(qid, n)[keep.ravel()], id_col: held_id[keep], "distance": held[keep]})

    top = vectors.select(id_col, vector_col).mapInPandas(best, f"query_id long, `{id_col}` long, distance double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", id_col))
    return top.withColumn("rank", rank).where(F.col("rank") <= n).withColumn("distance", F.round("distance", 6))
