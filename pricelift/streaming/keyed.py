"""A sink that holds one row per window and product: copy-on-write of the small parts that a batch touches.

Rows lie below date and bucket of the product.  A batch rewrites the (date, bucket) parts it has rows for, as a new
version beside the old one: nothing that readers use is overwritten, and a batch that runs again replaces its own
versions.  Readers take the newest version of every part; ``vacuum`` deletes the others.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.publish import folder
from .scoring import WINDOW_KEY

#: Buckets a date is cut into: with N rows a date a batch rewrites N / BUCKETS rows for each product it holds, at most all.
BUCKETS = 64
_PARTS = ("date", "bucket", "version")


def version_name(run: str, batch_id: int) -> str:
    """Name of a batch that sorts by run, then by number."""
    return f"{run}-{batch_id:012d}"


class KeyedSink:
    """The newest row of every key under a path.  ``key`` holds product_id and the start of the window."""

    def __init__(self, spark: SparkSession, path: str, key: tuple[str, ...] = WINDOW_KEY, time: str = "window_start", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.time, self.buckets = spark, path.rstrip("/"), key, time, buckets

    def versions(self) -> dict[tuple[str, str], list[str]]:
        """Versions of every part, oldest first: the names of folders, no file is opened."""
        fs, pattern = folder(self.spark, f"{self.path}/date=*/bucket=*/version=*")
        out: dict[tuple[str, str], list[str]] = {}
        for status in fs.globStatus(pattern) or []:
            names = str(status.getPath().toString()).rsplit("/", 3)[1:]
            date, bucket, version = (n.split("=", 1)[1] for n in names)
            out.setdefault((date, bucket), []).append(version)
        return {part: sorted(found) for part, found in out.items()}

    def _folder(self, part: tuple[str, str], version: str) -> str:
        return f"{self.path}/date={part[0]}/bucket={part[1]}/version={version}"

    def _read(self, paths: Iterable[str]) -> DataFrame | None:
        """Rows of some versions, without the columns they are stored by."""
        paths = sorted(paths)
        return self.spark.read.parquet(*paths) if paths else None

    def upsert(self, rows: DataFrame, version: str) -> None:
        """Put rows, at most one per key, in the place of those with their keys.

        The parts that the rows fall into are listed on the driver, as the writer lists them anyway; rows are read and written by
        tasks, and each part is exchanged once.  What an earlier run of the same version wrote is no base of it.
        """
        placed = rows.withColumns({"date": F.to_date(self.time), "bucket": F.pmod(F.xxhash64("product_id"), F.lit(self.buckets)).cast("int")}).persist()
        try:
            touched = {(str(r["date"]), str(r["bucket"])) for r in placed.select("date", "bucket").distinct().collect()}
            known = self.versions()
            bases = {}
            for part in touched:
                older = [v for v in known.get(part, []) if v < version]
                if older:
                    bases[part] = older[-1]
            if not touched:
                return
            kept = self._read(self._folder(part, v) for part, v in bases.items())
            whole = placed
            if kept is not None:
                # a stored row stays unless the batch has its key
                fresh = placed.select(*[F.col(c).alias(f"_{c}") for c in self.key])
                same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.key]
                left = kept.join(fresh, same, "left_anti")
                left = left.withColumns({"date": F.to_date(self.time), "bucket": F.pmod(F.xxhash64("product_id"), F.lit(self.buckets)).cast("int")})
                whole = placed.unionByName(left, allowMissingColumns=True)
            named = whole.withColumn("version", F.lit(version))
            writer = named.hint("rebalance", "date", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*_PARTS).parquet(self.path)
        finally:
            placed.unpersist()

    def read(self, dates: Iterable[str] | None = None) -> DataFrame:
        """One row per key; ``dates`` (as text) opens those dates only."""
        wanted = None if dates is None else set(dates)
        newest = [self._folder(part, found[-1]) for part, found in self.versions().items() if wanted is None or part[0] in wanted]
        rows = self._read(newest)
        if rows is None:
            raise FileNotFoundError(f"nothing is stored under {self.path}")
        return rows

    def vacuum(self, keep: int = 1) -> int:
        """Delete all but the newest ``keep`` versions of every part; readers that began before may still need two."""
        gone = 0
        for part, found in self.versions().items():
            for version in found[:-keep]:
                fs, target = folder(self.spark, self._folder(part, version))
                fs.delete(target, True)
                gone += 1
        return gone
