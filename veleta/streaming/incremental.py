"""Incremental landing, newest-wins upsert and freshness as streams."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veleta import tables
from veleta.operators.keys import identity, snapshot_dedup, upsert_newest
from veleta.plans.quality import SUCCESSFUL
from veleta.scratch import keep


def landing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New JSON files of a folder; the checkpoint of the query is the ledger."""
    return spark.readStream.schema(schema).json(path)


class VersionedTable:
    """A Parquet table in key buckets that split as they grow; a batch writes the buckets of its keys anew.

    The directory is that of extendible hashing: a bucket of depth d holds the
    keys whose hash ends in its d bits. A bucket that may come to hold more
    than twice `rows_per_bucket` rows is dealt to buckets of a greater depth
    when it is written next, so that buckets follow the table and a task never
    writes more than one of them. What is current is told by a log of bucket
    versions, one file a batch, folded into one file before its lines exceed
    twice the buckets.

    One writer at a time. A replayed batch finds the same newest rows, so the
    upsert is idempotent. Versions that no line of the log names are deleted:
    replaced ones when their successors are in place, those of a broken write
    by the next batch.
    """

    #: Log files that are read at most.
    MOST_FILES = 32

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], rows_per_bucket: int = 1_000_000):
        self.spark, self.path, self.schema, self.keys, self.rows_per_bucket = spark, path.rstrip("/"), schema, keys, rows_per_bucket

    def log_files(self) -> list[str]:
        return tables.children(self.spark, f"{self.path}/log")

    def log_lines(self) -> list[dict]:
        files = self.log_files()
        return [json.loads(line) for f in files for line in tables.get_text(self.spark, f"{self.path}/log/{f}").splitlines()]

    def directory(self) -> dict[tuple[int, int], dict]:
        """Version and rows of each bucket, by depth and last bits of the hash; one entry a bucket."""
        found: dict[tuple[int, int], dict] = {}
        for line in self.log_lines():
            at = line["depth"], line["bits"]
            if line["version"] is None:
                found.pop(at, None)
            else:
                found[at] = line
        return found

    def _read(self, buckets: list[dict]) -> DataFrame:
        if not buckets:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._folder(b) for b in buckets])

    def _folder(self, bucket: dict) -> str:
        return f"{self.path}/data/{bucket['version']}/bucket_={bucket['depth']}-{bucket['bits']}"

    def current(self) -> DataFrame:
        return self._read(list(self.directory().values()))

    def bucketed(self, rows: DataFrame, buckets: list[tuple[int, int]]) -> DataFrame:
        """Rows with `depth_` and `bits_` of their bucket; every hash has one."""
        deepest = max(d for d, _ in buckets)
        named = self.spark.createDataFrame(buckets, "depth_ int, bits_ long")
        steps = F.sequence(F.lit(0).cast("long"), F.expr(f"shiftleft(1L, {deepest} - depth_)") - 1)
        slots = named.withColumn("step_", F.explode(steps)).select("depth_", "bits_", (F.col("bits_") + F.col("step_") * F.expr("shiftleft(1L, depth_)")).alias("slot_"))
        hashed = F.xxhash64(*identity(rows, self.keys)).bitwiseAND(F.lit((1 << deepest) - 1).cast("long"))
        return rows.withColumn("slot_", hashed).join(slots, "slot_").drop("slot_")

    def merge(self, rows: DataFrame, version: list[str]) -> None:
        """Upsert rows, newest version first; only the buckets of their keys are read and written."""
        known, files = self.directory(), self.log_files()
        self._remove_broken(known)
        new = keep(self.spark, snapshot_dedup(rows, self.keys, version), "batch")
        buckets = list(known) or [(0, 0)]
        counted = self.bucketed(new, buckets).groupBy("depth_", "bits_").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a bucket
        if not counted:
            return
        targets, old, lines = [], [], []
        for depth, bits, n in counted:
            before = known.get((depth, bits))
            rows_then, split = n + (before["rows"] if before else 0), 0
            while rows_then > 2 * self.rows_per_bucket << split:
                split += 1
            targets += [(depth + split, bits + (i << depth)) for i in range(1 << split)]
            if before:
                old.append(before)
                if split:
                    lines.append({"depth": depth, "bits": bits, "version": None, "rows": 0})
        untouched = [b for b in buckets if b not in {(d, p) for d, p, _ in counted}]
        merged, name = upsert_newest(self._read(old), new, self.keys, version), f"v-{uuid.uuid4().hex}"
        placed = self.bucketed(merged, targets + untouched).withColumn("bucket_", F.concat_ws("-", "depth_", "bits_")).drop("depth_", "bits_")
        placed.repartition(len(targets), "bucket_").write.option("compression", "zstd").partitionBy("bucket_").parquet(f"{self.path}/data/{name}")
        written = self.spark.read.schema(f"{self.schema}, bucket_ string").parquet(f"{self.path}/data/{name}").groupBy("bucket_").count().collect()
        sizes = {tuple(map(int, r.bucket_.split("-"))): r["count"] for r in written}
        # a bucket without rows is known as well, for every hash has a bucket; it has no folder
        lines += [{"depth": d, "bits": p, "version": name, "rows": sizes.get((d, p), 0)} for d, p in targets]
        for d, p in targets:
            if (d, p) not in sizes:
                self._read([]).write.parquet(self._folder({"version": name, "depth": d, "bits": p}))
        self._append(lines, known, files)
        for b in old:
            tables.remove(self.spark, self._folder(b))

    def _append(self, lines: list[dict], known: dict, files: list[str]) -> None:
        """The next file of the log; the whole directory in place of all files when they have grown too long."""
        n = int(files[-1].split("-")[0]) + 1 if files else 1
        after = {**known, **{(x["depth"], x["bits"]): x for x in lines}}
        after = [x for x in after.values() if x["version"] is not None]
        folded = len(files) + 1 > self.MOST_FILES or len(self.log_lines()) + len(lines) > 2 * len(after)
        text = "\n".join(json.dumps(x) for x in (after if folded else lines))
        tables.put_text(self.spark, f"{self.path}/log/{n:012}-{'whole' if folded else 'part'}", text)
        if folded:  # a whole file says the same as those before it and itself
            for f in files:
                tables.remove(self.spark, f"{self.path}/log/{f}")
            self._remove_replaced(after)

    def _remove_replaced(self, current: list[dict]) -> None:
        """Folders of buckets that a broken writer replaced and did not come to delete."""
        named = {self._folder(b) for b in current}
        for version in {b["version"] for b in current}:
            for folder in tables.children(self.spark, f"{self.path}/data/{version}"):
                if folder.startswith("bucket_=") and f"{self.path}/data/{version}/{folder}" not in named:
                    tables.remove(self.spark, f"{self.path}/data/{version}/{folder}")

    def _remove_broken(self, known: dict) -> None:
        named = {b["version"] for b in known.values()}
        for version in tables.children(self.spark, f"{self.path}/data"):
            if version not in named:
                tables.remove(self.spark, f"{self.path}/data/{version}")


def upsert_stream(stream: DataFrame, table: VersionedTable, version: list[str], checkpoint: str) -> StreamingQuery:
    """Every micro-batch is merged into the table, newest version first; runs until the input is used up."""

    def merge(batch: DataFrame, _: int) -> None:
        table.merge(batch, version)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def freshness_stream(outcomes: DataFrame) -> DataFrame:
    """Latest status, attempt and success of each source; state is one row a source."""
    at = F.col("execution_timestamp")
    return outcomes.groupBy("source").agg(
        F.max_by("status", at).alias("latest_status"),
        F.max(at).alias("last_attempt_at"),
        F.max(F.when(F.col("status").isin(*SUCCESSFUL), at)).alias("last_success_at"),
        F.sum("records_extracted").alias("records_extracted"),
    )
