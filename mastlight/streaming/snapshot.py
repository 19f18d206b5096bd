"""A current state that stays small: the newest row of each entity, as versions of a table in the shared folder.

Rows of an entity live in one bucket.  A micro-batch rewrites the buckets that it touches below a folder of its own, then writes the
manifest, which names the folder of every bucket; readers go by the last manifest, so they see a whole version or the one
before.  The folders that the last ``KEPT`` manifests do not name are removed.  A batch that runs again starts from the manifest
before it and writes the same folders, so it counts once.  Nothing is kept in the stream's own state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mastlight.session import remove_folder
from mastlight.streaming.runs import batches_of, children

#: Manifests, and with them versions, that stay readable.
KEPT = 2


class Snapshot:
    """The newest row of each entity below a path; ``key`` is the column that names the entity."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def versions(self) -> list[int]:
        return batches_of(self.spark, f"{self.path}/manifest")

    def folders(self, batch_id: int) -> dict[int, str]:
        """The folder of each bucket in a version; one small row a bucket."""
        rows = self.spark.read.schema("bucket int, folder string").parquet(f"{self.path}/manifest/batch={batch_id}")
        return {r.bucket: r.folder for r in rows.collect()}

    def _rows(self, folders: Sequence[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, batch_id: int, newest: Column, keep: Column | None = None) -> None:
        """Take in a batch: per entity the row with the largest ``newest``; rows for which ``keep`` does not hold expire."""
        columns = batch.columns
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

        def best(rows: DataFrame) -> DataFrame:
            return rows.groupBy(self.key).agg(F.max_by(F.struct(*columns), newest).alias("_row")).select("_row.*")

        own = best(batch).withColumn("bucket", bucket)
        known = [v for v in self.versions() if v < batch_id]
        before = self.folders(known[-1]) if known else {}
        fresh = f"{self.path}/data/batch={batch_id}"
        # The batch goes to its buckets first; only those are read from the version before.
        arrived = f"{self.path}/arrived/batch={batch_id}"
        own.write.mode("overwrite").partitionBy("bucket").parquet(arrived)
        touched = sorted(int(name.split("=")[1]) for name in children(self.spark, arrived, "bucket="))
        schema = batch.schema
        old = self._rows([before[b] for b in touched if b in before], schema)
        new = self._rows([f"{arrived}/bucket={b}" for b in touched], schema)
        merged = best(old.unionByName(new))
        if keep is not None:
            merged = merged.where(keep)
        merged.withColumn("bucket", bucket).repartition(max(1, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(fresh)
        written = {int(name.split("=")[1]) for name in children(self.spark, fresh, "bucket=")}
        now = {b: f for b, f in before.items() if b not in touched} | {b: f"{fresh}/bucket={b}" for b in written}
        self.spark.createDataFrame(sorted(now.items()), "bucket int, folder string").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest/batch={batch_id}")
        remove_folder(self.spark, arrived)
        self.expire()

    def expire(self) -> None:
        """Remove manifests but for the last ones, and the folders that those do not name."""
        versions = self.versions()
        named = {folder for v in versions[-KEPT:] for folder in self.folders(v).values()}
        for version in versions[:-KEPT]:
            remove_folder(self.spark, f"{self.path}/manifest/batch={version}")
        for batch in children(self.spark, f"{self.path}/data", "batch="):
            folder = f"{self.path}/data/{batch}"
            if int(batch.split("=")[1]) > versions[-1]:
                continue
            inside = [f"{folder}/{name}" for name in children(self.spark, folder, "bucket=")]
            used = [f for f in inside if f in named]
            for old in inside if used else [folder]:
                if old not in named:
                    remove_folder(self.spark, old)
