"""N-gram Jaccard join by a MinHash LSH forest with exact verification (operator 4).

Documents are similar when the Jaccard similarity of their sets of five-word shingles (lower-cased
words between white space) is at least 0.8. ``similarity_join`` returns one row a document:
``class_id`` (the least doc_id of its connected component of links) and ``n_links`` (how many other
documents it is similar to, exact copies included).

Forest. Texts of equal shingle sets are folded into one node, so copies cost nothing later. Each node has a path in each of
``TREES`` prefix tries: ``MAX_DEPTH`` MinHash values of ``LEVEL_BITS`` bits, most significant first, so that sorted
paths are the sorted trie and a branch is a run of equal prefixes. The matched prefix starts at the deepest level and is shortened

- for all branches until the recall computed at the threshold and the recall measured reach the target. Measured:
  documents with ids divisible by 100 (at most ``QUERIES`` of them, drawn by hash) are joined exactly with all rows
  in the signing pass, which also notes how deep each true pair meets (``forest_depth``);
- then, branch by branch, by one more level where a node has met no other in any trie.

Verification is exact, on the shingle sets of whole texts. In a branch of more than ``BLOCK`` nodes, each node is first compared
with one representative (the ball's centre): nodes at a distance of at most half the threshold's are similar to each other by the triangle
inequality of the Jaccard distance, so a ball's links are counted from its size. What is left of a branch is dealt into blocks of about
``BLOCK`` nodes, and pairs of blocks that are not of one ball become units of work, which count their
links in a matrix product and return one row a member (its links and the root of its component within the unit), never the pairs. So a group
of close copies costs one comparison a node; only nodes farther apart than a ball meet pair by pair. No branch is capped or
dropped. A branch whose members equal those of an earlier trie's branch is verified once, and a pair is counted only in
the first trie that it shares.

Defined results: null texts and texts without words form a class of their own each and have no
link; texts of one to four words have one shingle, all their words; repeated rows are copies of
each other; a null doc_id is ignored when class ids are chosen (null only where a class has no
other); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicarium.llm.store import delete, stored, written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES = 16
MAX_DEPTH = 5
LEVEL_BITS = 12
TARGET_RECALL = 0.9995
#: The sample of exactly joined queries: at most so many documents, of at most so many shingles each.
QUERIES = 512
QUERY_SHINGLES = 5_000
BLOCK = 256
SEED = 20_031
#: Rows of under 200 bytes are broadcast up to this many, shingle sets up to CENTRES, else both sides are shuffled.
BROADCAST_ROWS = 200_000
CENTRES = 5_000
#: Parts of a hot key where a join beyond the broadcast meets one.
SALTS = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word -> 64-bit hash, remembered; bounded by ``fresh``."""

    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def fresh(self) -> WordHashes:
        if len(self) > 200_000:
            self.clear()
        return self


def shingle_set(text: str | None, known: WordHashes, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of n words; one run of all words where there are fewer."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.fresh().__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    s = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        s = s * _MIX + h[k : len(h) - n + 1 + k]
    s ^= s >> np.uint64(29)
    return np.unique(s * _MIX)


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, target: float = TARGET_RECALL, deepest: int = MAX_DEPTH) -> int:
    """The longest prefix, shortened from the deepest, at which a pair at the threshold meets in some trie with the target recall."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def _functions(trees: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, trees * MAX_DEPTH, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    return a, rng.integers(0, 1 << 63, trees * MAX_DEPTH, dtype=np.uint64)


def trie_paths(shingles: np.ndarray, trees: int, functions=None) -> np.ndarray:
    """A node's path in each trie, as one integer: LEVEL_BITS of each of its MAX_DEPTH MinHash values."""
    a, b = functions or _functions(trees)
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        np.minimum(least, (a[:, None] * shingles[None, at : at + 4096] + b[:, None]).min(axis=1), out=least)
    digit = ((least ^ (least >> np.uint64(29))) * _MIX >> np.uint64(64 - LEVEL_BITS)).reshape(trees, MAX_DEPTH)
    path = np.zeros(trees, np.uint64)
    for k in range(MAX_DEPTH):
        path = path << np.uint64(LEVEL_BITS) | digit[:, k]
    return path.view(np.int64)


def met_at(a: np.ndarray, b: np.ndarray) -> int:
    """The deepest level at which two nodes share a branch of some trie."""
    apart = int((a ^ b).min())
    return MAX_DEPTH - -(-apart.bit_length() // LEVEL_BITS)


class Sample:
    """Queries (sorted shingle sets and paths) that each signed node is compared with exactly."""

    def __init__(self, sets: list[np.ndarray], paths: list[np.ndarray]):
        self.sizes, self.paths = np.array([len(s) for s in sets], np.int64), paths
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.shingles, self.owner = flat[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def hits(self, shingles: np.ndarray, path: np.ndarray, threshold: float) -> np.ndarray | None:
        """How many queries of another shingle set are similar to the node, by the level where they meet it."""
        lo, hi = np.searchsorted(self.shingles, shingles), np.searchsorted(self.shingles, shingles, "right")
        lo, n = lo[hi > lo], (hi - lo)[hi > lo]
        if not len(n):
            return None
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        shared = np.bincount(self.owner[at], minlength=len(self.sizes))
        union = self.sizes + len(shingles) - shared
        near = np.flatnonzero((shared >= threshold * union) & (shared < union))
        return np.bincount([met_at(self.paths[q], path) for q in near], minlength=MAX_DEPTH + 1) if len(near) else None


def _sign(batches: Iterable[pa.RecordBatch], trees: int, sample, threshold: float) -> Iterator[pa.RecordBatch]:
    known, functions = WordHashes(), _functions(trees)
    queries = pickle.loads(sample.value)
    for batch in batches:
        nodes, paths, hits = [], [], []
        for text in batch.column("text"):
            s = shingle_set(text.as_py(), known)
            path = trie_paths(s, trees, functions) if len(s) else None
            found = queries.hits(s, path, threshold) if len(s) and len(queries.shingles) else None
            nodes.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
            paths.append(path)
            hits.append(found)
        columns = [batch.column("doc_id"), batch.column("th"), pa.array(nodes, pa.binary()), pa.array(paths, pa.list_(pa.int64())), pa.array(hits, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "node", "paths", "hits"])


def _shingled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of texts, in place of the texts."""
    known = WordHashes()
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            sets = [shingle_set(t.as_py(), known).view(np.int64) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("node"), part.column("copies"), part.column("paths"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "copies", "paths", "shingles"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a unit's sets: a blocked product of presence matrices."""
    n = len(sets)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = counts[inverse] > 1  # a shingle of one set alone adds nothing
    column = (np.cumsum(counts > 1) - 1)[inverse[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total, width = np.zeros((n, n), np.float32), 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        present = np.zeros((n, width), np.float32)
        present[owner[lo:hi], column[lo:hi] - at] = 1
        total += present @ present.T
    return total


def _roots(linked: np.ndarray, nodes: list[bytes]) -> list[bytes]:
    """Of each member, the least node of its component in the boolean matrix."""
    rank = np.argsort(np.argsort(np.array(nodes, object)))
    while True:
        least = np.minimum(rank, np.where(linked, rank[None, :], len(rank)).min(axis=1))
        if (least == rank).all():
            break
        rank = least
    ordered = sorted(nodes)
    return [ordered[r] for r in rank]


def _unit(rows: list[tuple], trie: int, shift: int, cross: bool, threshold: float) -> Iterator[tuple]:
    """(node, root, links) of the members of one unit that have a link counted in it."""
    sides, copies, nodes, balls, paths, shingles = zip(*rows, strict=True)
    sets = [np.array(x, np.int64).view(np.uint64) for x in shingles]
    size = np.array([len(s) for s in sets], np.float64)
    linked = overlaps(sets) * (1 + threshold) >= threshold * (size[:, None] + size[None, :]) - 1e-6
    np.fill_diagonal(linked, False)
    table = np.array(paths, np.int64) >> shift
    for t in range(trie):  # counted in an earlier trie
        linked &= table[:, t][:, None] != table[:, t][None, :]
    index = {b: i for i, b in enumerate(dict.fromkeys(balls))}
    ball = np.array([index[b] for b in balls])
    linked &= (ball[:, None] != ball[None, :]) | (np.array([b is None for b in balls]))[:, None]  # counted by their ball
    if cross:
        side = np.array(sides)
        linked &= side[:, None] != side[None, :]
    links = linked @ np.array(copies, np.int64)
    for node, root, n in zip(nodes, _roots(linked, list(nodes)), links, strict=True):
        if n:
            yield node, root, int(n)


UNIT = ["depth", "t", "label", "lo", "hi"]


def _verify(batches: Iterable[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Batches sorted by unit; a unit may span batches."""
    unit, rows, out = None, [], []

    def packed() -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["node", "root", "links"])

    def ended() -> None:
        if len(rows) > 1:
            depth, t, _, lo, hi = unit
            out.extend(_unit(rows, t, LEVEL_BITS * (MAX_DEPTH - depth), lo != hi, threshold))

    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for depth, t, label, lo, hi, *row in zip(*[c.to_pylist() for c in part.columns], strict=True):
                if (depth, t, label, lo, hi) != unit:
                    ended()
                    unit, rows = (depth, t, label, lo, hi), []
                rows.append(tuple(row))
            yield packed()
            out.clear()
    ended()
    yield packed()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the least node each node reaches over edges (u, v); least-label steps with pointer jumping, a shared-folder table a round, of which the last stays."""
    spark = edges.sparkSession
    both, edge_path = stored(edges.where("u <> v").select("u", "v").union(edges.where("u <> v").select("v", "u")).distinct(), f"{name}-edges")
    labels, path = stored(both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("component")), name)
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", F.col("component").alias("old"), F.least("component", "near").alias("next"))
        far = labels.select(F.col("node").alias("at"), F.col("component").alias("far"))
        jumped, new = stored(step.join(far, step["next"] == far["at"], "left").select("node", "old", F.least("next", F.coalesce("far", "next")).alias("component")), name)
        delete(spark, path)
        labels, path = jumped.select("node", "component"), new
        if jumped.where("component <> old").isEmpty():
            delete(spark, edge_path)
            return labels


def _sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast when it is counted to be small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _hot_join(rows: DataFrame, side: DataFrame, key: str, name: str, salt: str, how: str = "inner") -> DataFrame:
    """rows joined with side on rows.key = side.name, where one key may hold a third of the rows: side broadcast when it is counted to be small, else both sides salted."""
    if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(side), F.col(key) == F.col(name), how)
    salted = rows.withColumn("salt_", F.pmod(F.xxhash64(salt), F.lit(SALTS)))
    parts = side.withColumn("salted_", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    return salted.join(parts, (F.col(key) == F.col(name)) & (F.col("salt_") == F.col("salted_")), how)


def query_sample(keyed: DataFrame, trees: int, most: int = QUERIES) -> Sample:
    """The exactly joined queries: of the rows whose id is divisible by 100, ``most`` by a hash (the share is set by their count)."""
    rows = keyed.where(F.col("doc_id") % 100 == 0).where(F.col("text").isNotNull())
    share = most / max(1, rows.count())
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("queries"), "doc_id"), 11) / F.lit(float(1 << 53))
    drawn = rows.where(draw < share).select(F.col("th").alias("node"), F.lit(1).cast("long").alias("copies"), F.array().cast("array<long>").alias("paths"), "text")
    sets = [np.array(r.shingles, np.int64).view(np.uint64) for r in drawn.mapInArrow(_shingled, "node binary, copies long, paths array<long>, shingles array<long>").where(F.size("shingles").between(1, QUERY_SHINGLES)).select("shingles").limit(2 * most).collect()]
    return Sample(sets, [trie_paths(s, trees) for s in sets])


def forest_depth(signed: DataFrame, threshold: float, trees: int, recall: float) -> tuple[int, float | None]:
    """(depth, measured recall at it): the computed depth, shortened until the sample's true pairs meet with the target recall; None without such pairs."""
    hits = signed.where("hits is not null").agg(*[F.coalesce(F.sum(F.get("hits", F.lit(k))), F.lit(0)) for k in range(MAX_DEPTH + 1)]).first()
    depth = prefix_depth(threshold, trees, recall)
    at = lambda d: sum(hits[d:]) / sum(hits) if sum(hits) else None
    while depth > 1 and sum(hits) and at(depth) < recall:
        depth -= 1
    return depth, at(depth)


def _branches(slots: DataFrame, depth: int) -> DataFrame:
    """(depth, t, label, c, node, lonely): the members of branches of two or more nodes, of which one at least is lonely; branches of equal members once."""
    placed = slots.withColumn("label", F.shiftrightunsigned("path", LEVEL_BITS * (MAX_DEPTH - depth)))
    found = placed.groupBy("t", "label").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(SEED), "node")).alias("y"), F.max("lonely").alias("wanted")).where("c > 1 and wanted")
    once = found.groupBy("c", "x", "y").agg(F.min(F.struct("t", "label")).alias("k")).select("k.t", "k.label", "c")
    return placed.join(_sized(written(once, "branches")), ["t", "label"]).select(F.lit(depth).alias("depth"), "t", "label", "c", "node", "lonely")


def _balls(members: DataFrame, sets: DataFrame, block: int, threshold: float) -> DataFrame:
    """(node, centre): nodes of large branches within half the threshold's distance of a representative of the largest one that holds them."""
    large = members.where(F.col("c") > block)
    centres = large.groupBy("t", "label").agg(F.min("node").alias("centre"))
    home = large.join(_sized(written(centres, "centres")), ["t", "label"]).groupBy("node").agg(F.max_by("centre", F.struct("c", "centre")).alias("centre"))
    home = written(home, "homes")
    salts = F.array(*[F.lit(k) for k in range(SALTS)])
    middle = sets.join(_sized(home.select(F.col("centre").alias("node")).distinct()), "node").select(F.col("node").alias("centre_"), F.col("shingles").alias("middle"))
    if middle.limit(CENTRES + 1).count() <= CENTRES:
        both = sets.join(home, "node").join(F.broadcast(middle), F.col("centre") == F.col("centre_"))
    else:  # a centre may be a hot key
        salted = sets.join(home, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
        both = salted.join(middle.withColumn("salt_", F.explode(salts)), (F.col("centre") == F.col("centre_")) & (F.col("salt") == F.col("salt_")))
    shared = F.size(F.array_intersect("shingles", "middle"))
    inside = shared >= (1 - (1 - threshold) / 2 + 1e-9) * (F.size("shingles") + F.size("middle") - shared)
    return both.where(inside).select("node", "centre")


def _units(members: DataFrame, block: int) -> DataFrame:
    """(depth, t, label, lo, hi, side, node, ball): the pairs of blocks of each branch, blocks of one ball not with each other nor themselves."""
    branch = ["depth", "t", "label"]
    sizes = members.groupBy(*branch, "ball").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block))).cast("int").alias("parts"))
    sides = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.xxhash64("ball", i))
    group = F.struct(F.xxhash64("ball").alias("k"), "parts", sides.alias("sides"))
    blocks = sizes.groupBy(*branch).agg(F.collect_list(group).alias("groups"))  # a value a block, not a node
    dealt = members.withColumn("k", F.xxhash64("ball")).withColumn("free", F.col("ball").isNull()).join(_sized(written(blocks, "blocks")), branch)
    own = F.filter("groups", lambda g: g["k"] == F.col("k"))[0]["parts"]
    dealt = dealt.withColumn("side", F.xxhash64("ball", F.pmod(F.xxhash64(F.lit(SEED + 1), "node"), own).cast("int")))
    others = F.flatten(F.transform(F.filter("groups", lambda g: F.col("free") | (g["k"] != F.col("k"))), lambda g: g["sides"]))
    out = dealt.select(*branch, "node", "ball", "side", F.explode(others).alias("other"))
    return out.select(*branch, F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "node", "ball")


def classified(docs: DataFrame, threshold: float, trees: int, recall: float, block: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, float | None]:
    """(doc_id, th, node) of every row, node null where there is no word; of every node with a link or copies its class, copies, links and the row that stands for it; and the measured recall."""
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.unhex(F.md5(F.col(f"`{text_col}`"))).alias("th"), F.col(f"`{text_col}`").alias("text"))
    sample = docs.sparkSession.sparkContext.broadcast(pickle.dumps(query_sample(keyed, trees)))
    signed = written(keyed.mapInArrow(lambda it: _sign(it, trees, sample, threshold), "doc_id long, th binary, node binary, paths array<long>, hits array<long>"), "signatures")
    depth, measured = forest_depth(signed, threshold, trees, recall)
    nodes = written(signed.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("at"), F.first("paths").alias("paths")), "nodes")
    # the forest at its depth, then one level up for the nodes that met no other
    slots = nodes.select("node", F.posexplode("paths").alias("t", "path"), F.lit(True).alias("lonely"))
    members = written(_branches(slots, depth), "members")
    if depth > 1:
        met = members.select(F.col("node").alias("met_")).distinct()
        left = nodes.select("node", "paths").join(met, F.col("node") == F.col("met_"), "left").select("node", F.posexplode("paths").alias("t", "path"), F.col("met_").isNull().alias("lonely"))
        more = written(_branches(left, depth - 1), "members")
    else:
        more = members.limit(0)
    wanted = members.select("node").union(more.select("node")).distinct()
    few = _sized(written(nodes.join(wanted, "node").select("node", "copies", "paths", F.col("at.doc_id").alias("at_id"), F.col("at.th").alias("at_th")), "wanted"))
    texts = keyed.join(few, keyed["doc_id"].eqNullSafe(few["at_id"]) & (keyed["th"] == few["at_th"])).select(few["node"], "copies", "paths", "text").dropDuplicates(["node"])
    sets = written(texts.mapInArrow(_shingled, "node binary, copies long, paths array<long>, shingles array<long>"), "sets")
    balls = written(_balls(members, sets, block, threshold), "balls")
    # pairs of one ball are counted by it; above the forest's depth, so are pairs of nodes that met others
    inside = members.join(balls.select(F.col("node").alias("node_"), "centre"), F.col("node") == F.col("node_"), "left").select("depth", "t", "label", "node", F.col("centre").alias("ball"))
    above = more.select("depth", "t", "label", "node", F.when(~F.col("lonely"), F.lit(b"met")).alias("ball"))
    units = _units(inside.unionByName(above), block)
    rows = units.join(sets, "node").select(*UNIT, "side", "copies", "node", "ball", "paths", "shingles").repartition(*UNIT).sortWithinPartitions(*UNIT)
    verified = written(rows.mapInArrow(lambda it: _verify(it, threshold), "node binary, root binary, links long"), "verified")
    centred = balls.join(nodes.select("node", "copies"), "node")
    size = _sized(centred.groupBy(F.col("centre").alias("centre_")).agg(F.sum("copies").alias("size")))
    by_ball = centred.join(size, F.col("centre") == F.col("centre_")).select("node", F.col("centre").alias("root"), (F.col("size") - F.col("copies")).alias("links"))
    linked = written(verified.unionByName(by_ball), "linked")
    components = connected_components(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "copies", "at").join(components, "node", "left").join(links, "node", "left").where("copies > 1 or links > 0").withColumn("component", F.coalesce("component", "node"))
    known = written(known, "known")
    classes = written(known.groupBy(F.col("component").alias("class_")).agg(F.min(F.struct("at", "node")).alias("first")), "classes")
    info = _hot_join(known, classes, "component", "class_", "node").select("node", F.col("first.at.doc_id").alias("class_id"), "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), (F.col("node") == F.col("first.node")).alias("stands"), "at")
    return signed.select("doc_id", "th", "node"), written(info, "info"), measured


def similarity_join(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = TARGET_RECALL, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_copies, n_links, measured_recall), one row a row of docs; measured_recall: of the forest on the sample of exactly joined queries, null where they are similar to nothing."""
    rows, info, measured = classified(docs, threshold, trees, recall, block, id_col, text_col)
    joined = _hot_join(rows, info.withColumnRenamed("node", "node_"), "node", "node_", "doc_id", "left")
    alone = F.col("node_").isNull()
    return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.lit(measured).cast("double").alias("measured_recall"))


def keep_one_of_each_class(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class of similar documents, that of the class id; rows without words stay."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows, info, _ = classified(row, threshold, TREES, TARGET_RECALL, BLOCK, "doc_id", "text")
    # the rows that a class of two or more documents decides: far fewer than all, so they travel to the texts
    chosen = F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("th") == F.col("at.th"))
    decided = written(_hot_join(rows, info.withColumnRenamed("node", "node_"), "node", "node_", "doc_id").select(F.col("doc_id").alias("id_"), F.col("th").alias("th_"), (F.col("stands") & chosen).alias("stays_")).distinct(), "decided")
    marked = row.join(_sized(decided), F.col("doc_id").eqNullSafe(F.col("id_")) & (F.unhex(F.md5("text")) == F.col("th_")), "left").where("stays_ is null or stays_")
    single = marked.where("stays_ is null").select("row")
    repeated = marked.where("stays_").dropDuplicates(["id_", "th_"]).select("row")
    return single.unionByName(repeated).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
