"""Published tables: immutable versions of a keyed table, changed by buckets, switched by one small file.

A table is a folder of bucket folders and of numbered version files. A version file lists, for every
bucket (hash of the key), the folder that holds its rows; it appears whole, by a rename, or not at
all, so a reader sees the version before or the one after and never a part of one, also when the
writer dies. A merge reads and rewrites only the buckets that its rows touch and carries the others'
folders over. A writer whose version number another writer took first begins again from that version.
Earlier versions stay readable (the archive) until ``expire``.

Version files hold a row a bucket: their size follows from the number of buckets, not of rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class VersionTaken(RuntimeError):
    """Another writer committed this version first."""


@dataclass
class PublishedTable:
    """A keyed table below ``root``; ``key`` columns decide the bucket and, in merges, which rows are the same."""

    spark: SparkSession
    root: str
    key: list[str]
    buckets: int = 64
    claim_seconds: float = 600
    _fs: object = field(default=None, repr=False)

    # --- files -------------------------------------------------------------------------------
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root.rstrip("/"), *parts]))

    def _files(self):
        if self._fs is None:
            self._fs = self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())
        return self._fs

    def versions(self) -> list[int]:
        folder = self._path("_versions")
        if not self._files().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files().listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, by default the last; an empty one where there is none."""
        known = self.versions()
        if version is None:
            if not known:
                return {"version": 0, "schema": None, "buckets": {}, "rows": 0}
            version = known[-1]
        stream = self._files().open(self._path("_versions", f"{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> dict:
        text = json.dumps(manifest, sort_keys=True).encode()
        final, draft = self._path("_versions", f"{manifest['version']:012d}.json"), self._path("_versions", f".{uuid.uuid4().hex}")
        stream = self._files().create(draft, False)
        stream.write(bytearray(text))
        stream.close()
        # only one writer can make the claim's file; the rename itself may replace a file on some stores
        claim = self._path("_claims", f"{manifest['version']:012d}")
        if self._files().exists(final) or not self._claimed(claim) or not self._files().rename(draft, final):
            self._files().delete(draft, False)
            raise VersionTaken(f"version {manifest['version']} of {self.root}")
        return manifest

    def _claimed(self, claim) -> bool:
        from py4j.protocol import Py4JJavaError

        self._files().mkdirs(claim.getParent())
        try:
            self._files().create(claim, False).close()  # fails where the file exists
        except Py4JJavaError:
            # the rename follows a claim at once: an old claim without its version is a dead writer's
            if time.time() - self._files().getFileStatus(claim).getModificationTime() / 1000 > self.claim_seconds:
                self._files().delete(claim, False)
            return False
        return True

    # --- reading -----------------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the last by default)."""
        found = self.manifest(version)
        if found["schema"] is None:
            raise ValueError(f"{self.root} holds no version")
        return self._rows(found, None)

    def _rows(self, manifest: dict, only: list[str] | None) -> DataFrame:
        folders = sorted({b["folder"] for k, b in manifest["buckets"].items() if only is None or k in only})
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(manifest["schema"])
        paths = [str(self._path(f).toString()) for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    # --- writing -----------------------------------------------------------------------------
    def replace(self, rows: DataFrame) -> dict:
        """Publish rows as the next version; the ones before stay as archive."""
        return self._publish(lambda base: (rows, list(range(self.buckets))))

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> dict:
        """Publish the table with rows merged in: of equal keys the new row stays, or what ``combine`` makes of old and new rows (column ``is_new``) grouped by the key columns it is given.

        Only buckets that rows touch are read and written. ``rows`` must not repeat a key unless ``combine`` settles it. Rows are
        dealt out by bucket once; grouping (by bucket and key) and writing need no other shuffle.
        """
        touched = [r.b for r in rows.select(self.bucket().alias("b")).distinct().collect()]  # at most a row a bucket
        if not touched:
            return self.manifest()

        def merged(base: dict):
            new = rows.withColumn("is_new", F.lit(True))
            if base["schema"] is None:
                both = new
            else:
                both = self._rows(base, [str(b) for b in touched]).withColumn("is_new", F.lit(False)).unionByName(new, allowMissingColumns=True)
            dealt, keys = self._dealt(both, len(touched)), ["bucket_", *self.key]
            if combine is not None:
                return combine(dealt, keys), touched
            rest = [c for c in both.columns if c not in (*self.key, "is_new")]
            last = dealt.groupBy(*keys).agg(F.max_by(F.struct(*rest), "is_new").alias("r_")) if rest else dealt.select(*keys).distinct()
            return last.select(*keys, *[F.col(f"r_.{c}").alias(c) for c in rest]), touched

        return self._publish(merged)

    def _dealt(self, rows: DataFrame, touched: int) -> DataFrame:
        return rows.withColumn("bucket_", self.bucket()).repartition(max(1, min(self.buckets, touched)), "bucket_")

    def _publish(self, make: Callable[[dict], tuple[DataFrame, list[int]]], tries: int = 10) -> dict:
        for _ in range(tries):
            base = self.manifest()
            rows, touched = make(base)
            folder = f"data-{uuid.uuid4().hex}"
            target = str(self._path(folder).toString())
            placed = rows if "bucket_" in rows.columns else self._dealt(rows, len(touched))
            placed.write.partitionBy("bucket_").parquet(target)
            written = self.spark.read.schema(placed.schema).parquet(target).groupBy("bucket_").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a bucket
            buckets = {k: b for k, b in base["buckets"].items() if int(k) not in set(touched)}
            buckets |= {str(r.bucket_): {"folder": f"{folder}/bucket_={r.bucket_}", "rows": r.n} for r in written}
            manifest = {"version": base["version"] + 1, "schema": json.loads(placed.drop("bucket_").schema.json()), "key": self.key, "of": self.buckets, "buckets": buckets, "rows": sum(b["rows"] for b in buckets.values()), "written": len(touched)}
            self._files().mkdirs(self._path("_versions"))
            try:
                return self._commit(manifest)
            except VersionTaken:
                self._files().delete(self._path(folder), True)
        raise VersionTaken(f"{tries} times in a row at {self.root}")

    def expire(self, keep: int = 1) -> int:
        """Remove all but the last ``keep`` versions and the folders only they name; returns how many versions went."""
        known = self.versions()
        gone, kept = known[:-keep], known[-keep:]
        used = {b["folder"].split("/")[0] for v in kept for b in self.manifest(v)["buckets"].values()}
        old = {b["folder"].split("/")[0] for v in gone for b in self.manifest(v)["buckets"].values()} - used
        for v in gone:
            self._files().delete(self._path("_versions", f"{v:012d}.json"), False)
        for folder in old:
            self._files().delete(self._path(folder), True)
        return len(gone)


def export_rows(rows: DataFrame, path: str, order: list, most: int = 500_000) -> DataFrame:
    """Write the first ``most`` rows in order as JSON lines (the cap is the export's own); returns (rows, written, truncated)."""
    total = rows.agg(F.count(F.lit(1)).alias("rows"))
    rows.orderBy(*order).limit(most).write.json(path)
    return total.select("rows", F.least("rows", F.lit(most)).alias("written"), (F.col("rows") > most).alias("truncated"))
