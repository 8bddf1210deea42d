"""Sharding by size-tiered compaction with versioned manifests (operator 7; DataFrame functions only).

A sharded table is a folder. ``data/<run>`` holds the immutable Parquet shards that one append or merge
wrote, ``shards/<run>`` a Parquet table of their (path, bytes, rows), ``manifests/`` one Parquet table of
live runs (run, bytes, rows, shards, tier) per version, and ``versions/`` one small file per committed version that names
its manifest. ``append`` writes arrivals as small shards straight from their partitions; ``compact``
merges runs of similar shard size into files near the target; each commits the next version by renaming
its version file into place, which fails if that version exists, so readers see the old table or the
new one and two writers cannot both win.

Tiers: a run's tier follows the mean size of its shards, in powers of ``FANOUT`` from ``TIER_BASE``. A tier whose
unsettled runs (mean shard of at most half the target) hold ``FANOUT`` shards or more is merged; what it
would become may fill the next tier, so the plan is made on sizes first (``planned``) and every shard is rewritten once.
A merge is one job of any size without a shuffle: Spark's reader packs whole files, largest first, into
partitions of up to the target, and each is written as one file. The driver sees a row a run, never a row a shard.

Defined results: every row of every append is in the latest version exactly once, repeated rows
and null values included, with all columns (also one named ``_metadata`` or ``path``); an empty append commits a version without a new
run; an empty table compacts to itself; texts of any length stay whole.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 64 << 20
SHARD_ROWS = 2_000
TIER_BASE = 1 << 20
FANOUT = 4
RUNS = "run string, bytes long, rows long, shards long, tier int"
SHARDS = "path string, bytes long, rows long"


def tier_of(mean_bytes: float) -> int:
    return 0 if mean_bytes < TIER_BASE else int(math.log(mean_bytes / TIER_BASE, FANOUT) + 1e-9) + 1


def planned(runs: list[tuple[str, int, int]], target_bytes: int) -> list[list[str]]:
    """Of runs (name, bytes, shards), the groups to merge: tiers with FANOUT shards or more, from the smallest, over and over with what their merge would give."""
    parts = [([name], size, shards, False) for name, size, shards in runs]
    while True:
        tiers: dict[int, list] = {}
        for part in parts:
            if part[2] and 2 * part[1] <= target_bytes * part[2]:
                tiers.setdefault(tier_of(part[1] / part[2]), []).append(part)
        full = [t for t in sorted(tiers) if sum(p[2] for p in tiers[t]) >= FANOUT]
        if not full:
            return [names for names, _, _, merged in parts if merged]
        group = tiers[full[0]]
        size, shards = sum(p[1] for p in group), sum(p[2] for p in group)
        after = min(max(1, math.ceil(size / target_bytes)), shards - 1)
        parts = [p for p in parts if p not in group] + [(sorted(n for p in group for n in p[0]), size, after, True)]


class ShardedTable:
    """A table of immutable shards under ``root`` (any Hadoop path that driver and executors share)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- versions -------------------------------------------------------------------------
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def version(self) -> int:
        """The latest committed version, 0 before the first."""
        fs, p = self._fs(f"{self.root}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return max((int(n) for n in names if n.isdigit()), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The live runs of a version (default: the latest)."""
        v = self.version() if version is None else version
        if v == 0:
            return self.spark.createDataFrame([], RUNS)
        fs, p = self._fs(f"{self.root}/versions/{v:08d}")
        stream = fs.open(p)
        try:
            name = stream.readUTF()
        finally:
            stream.close()
        return self.spark.read.schema(RUNS).parquet(f"{self.root}/manifests/{name}")

    def commit(self, manifest: DataFrame, base: int) -> int:
        """Publish manifest as version base + 1; raises if another writer has published it."""
        name = f"{base + 1:08d}-{uuid.uuid4().hex}"
        manifest.coalesce(1).write.parquet(f"{self.root}/manifests/{name}")
        fs, temp = self._fs(f"{self.root}/versions/.{name}")
        stream = fs.create(temp, False)
        stream.writeUTF(name)
        stream.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri() if temp.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(temp, self._fs(f"{self.root}/versions/{base + 1:08d}")[1], none)
        return base + 1

    # --- runs -----------------------------------------------------------------------------
    def _described(self, run: str, schema) -> DataFrame:
        """The one row of the manifest for a written run; its shards are described once, from their footers."""
        files = self.spark.read.schema(schema).parquet(f"{self.root}/data/{run}").select(F.expr("_metadata.file_path").alias("path"), F.expr("_metadata.file_size").alias("bytes")) if "_metadata" not in schema.names else self._files(run)
        files.groupBy("path", "bytes").agg(F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/shards/{run}")
        mean = F.col("bytes") / F.greatest(F.col("shards"), F.lit(1))
        tier = F.when(mean < TIER_BASE, 0).otherwise(F.floor(F.log(mean / TIER_BASE) / math.log(FANOUT) + 1e-9) + 1)
        whole = self.shards([run]).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("shards"))
        return whole.where("rows > 0").select(F.lit(run).alias("run"), "bytes", "rows", "shards", tier.cast("int").alias("tier"))

    def _files(self, run: str) -> DataFrame:
        """As the reader's metadata, for tables with a column of that name: rows are counted without any column."""
        bare = self.spark.read.schema("`lexicarium none` int").parquet(f"{self.root}/data/{run}")
        return bare.select(F.expr("_metadata.file_path").alias("path"), F.expr("_metadata.file_size").alias("bytes"))

    def shards(self, runs: list[str] | None = None) -> DataFrame:
        """(path, bytes, rows) of the shards of runs (default: those of the latest version)."""
        runs = [r.run for r in self.manifest().select("run").collect()] if runs is None else runs  # a row a run
        return self.spark.read.schema(SHARDS).parquet(*[f"{self.root}/shards/{r}" for r in runs]) if runs else self.spark.createDataFrame([], SHARDS)

    def append(self, rows: DataFrame, shard_rows: int = SHARD_ROWS) -> int:
        """Write arrivals as immutable shards of at most shard_rows rows and commit them."""
        base, run = self.version(), f"append-{uuid.uuid4().hex}"
        rows.write.option("maxRecordsPerFile", shard_rows).option("compression", "zstd").parquet(f"{self.root}/data/{run}")
        return self.commit(self.manifest(base).unionByName(self._described(run, rows.schema)), base)

    def compact(self, schema, target_bytes: int = TARGET_BYTES) -> int:
        """Merge the tiers that are full into files near target_bytes and commit the result; the version stays where there is nothing to merge."""
        base = self.version()
        runs = [(r.run, r.bytes, r.shards) for r in self.manifest(base).collect()]  # a row a run
        groups = planned(runs, target_bytes)
        if not groups:
            return base
        packing = self.spark.newSession()  # its reader packs whole files up to the target
        for key, value in (("maxPartitionBytes", target_bytes), ("openCostInBytes", 0), ("minPartitionNum", 1)):
            packing.conf.set(f"spark.sql.files.{key}", str(value))
        manifest = self.manifest(base).where(~F.col("run").isin([n for g in groups for n in g]))
        for names in groups:
            run = f"merge-{uuid.uuid4().hex}"
            packing.read.schema(schema).parquet(*[f"{self.root}/data/{n}" for n in names]).write.option("compression", "zstd").parquet(f"{self.root}/data/{run}")
            manifest = manifest.unionByName(self._described(run, schema))
        return self.commit(manifest, base)

    def read(self, schema, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the latest), with ``_metadata`` of their shard; runs are read as folders."""
        runs = [r.run for r in self.manifest(version).select("run").collect()]  # a row a run
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{n}" for n in runs]) if runs else self.spark.createDataFrame([], schema)

    def vacuum(self) -> int:
        """Delete the runs that the latest version does not name; returns how many. Older versions end with it."""
        live = {r.run for r in self.manifest().select("run").collect()}
        gone = 0
        fs, data = self._fs(f"{self.root}/data")
        for status in fs.listStatus(data) if fs.exists(data) else []:
            name = status.getPath().getName()
            if name not in live:
                fs.delete(status.getPath(), True)
                fs.delete(self._fs(f"{self.root}/shards/{name}")[1], True)
                gone += 1
        return gone
