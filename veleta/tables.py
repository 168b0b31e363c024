"""Tables of Parquet files that change in one step: snapshots of several tables, tables by run, widened schemas.

Data files are never changed in place. What is current is told by a pointer, a
small file that gets its name when it is whole (a rename); a crash before that
leaves the old state, and what it wrote is removed by the next writer. There is
one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veleta.scratch import file_system


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, at = file_system(spark, path)
    hidden = file_system(spark, f"{at.getParent()}/.{uuid.uuid4().hex}")[1]
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(at, False)
    if not fs.rename(hidden, at):
        raise OSError(f"cannot write {path}")


def get_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    source = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; none where there is no folder."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(at)) if not n.startswith("."))


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


class Snapshots:
    """Several tables of which readers see one common state: a pointer names the version of each."""

    def __init__(self, spark: SparkSession, root: str, keep_last: int = 2):
        self.spark, self.root, self.keep_last = spark, root.rstrip("/"), keep_last

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in children(self.spark, f"{self.root}/_snapshots")]

    def state(self, number: int | None = None) -> dict[str, dict]:
        """Version and schema of each table in a snapshot, the newest one by default; nothing where there is none."""
        numbers = self.numbers()
        if not numbers:
            return {}
        return json.loads(get_text(self.spark, f"{self.root}/_snapshots/{number or numbers[-1]:012}.json"))

    def publish(self, tables: Mapping[str, DataFrame], partition_by: Mapping[str, Sequence[str]] | None = None) -> int:
        """Write the given tables and let them and all others of the last snapshot be the next one; its number.

        The tables may read those of the last snapshots, which stay as they are.
        """
        state, numbers = self.state(), self.numbers()
        self._clear(numbers)
        for name, rows in tables.items():
            version = f"v-{uuid.uuid4().hex}"
            rows.write.option("compression", "zstd").partitionBy(*(partition_by or {}).get(name, ())).parquet(f"{self.root}/{name}/{version}")
            state[name] = {"version": version, "schema": rows.schema.json()}
        number = (numbers[-1] if numbers else 0) + 1
        put_text(self.spark, f"{self.root}/_snapshots/{number:012}.json", json.dumps(state))
        return number

    def read(self, name: str, number: int | None = None) -> DataFrame:
        known = self.state(number)[name]
        return self.spark.read.schema(StructType.fromJson(json.loads(known["schema"]))).parquet(f"{self.root}/{name}/{known['version']}")

    def has(self, name: str) -> bool:
        return name in self.state()

    def _clear(self, numbers: list[int]) -> None:
        """Remove snapshots before the last ones, and versions that none of the others names (of earlier or broken writes)."""
        for n in numbers[: -self.keep_last]:
            remove(self.spark, f"{self.root}/_snapshots/{n:012}.json")
        named = {(t, s["version"]) for n in numbers[-self.keep_last :] for t, s in self.state(n).items()}
        for table in children(self.spark, self.root):
            for version in children(self.spark, f"{self.root}/{table}") if table != "_snapshots" else ():
                if (table, version) not in named:
                    remove(self.spark, f"{self.root}/{table}/{version}")


class RunTables:
    """Tables whose rows belong to runs; a run's rows in all of them are replaced in one step, by none where it has none."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, str], run: str = "run_id"):
        self.spark, self.root, self.schemas, self.run = spark, root.rstrip("/"), dict(schemas), run

    def persist(self, run_id: str, tables: Mapping[str, DataFrame]) -> None:
        """The rows of a run: those given, and none in tables that are not given. Rows of other runs are an error."""
        version = f"v-{uuid.uuid4().hex}"
        for name, rows in tables.items():
            own = F.when(F.col(self.run) == run_id, F.lit(version)).otherwise(F.raise_error(F.lit(f"a row of {name} is not of run {run_id}")))
            at = f"{self.root}/{name}"
            rows.select(*StructType.fromDDL(self.schemas[name]).names).withColumn("version_", own).write.mode("append").partitionBy("version_").parquet(at)
        name = f"{self.root}/_runs/{uuid.uuid5(uuid.NAMESPACE_URL, run_id).hex}.json"
        before = json.loads(get_text(self.spark, name))["version"] if name.rsplit("/", 1)[1] in children(self.spark, f"{self.root}/_runs") else None
        put_text(self.spark, name, json.dumps({"run": run_id, "version": version}))
        if before is not None:
            for table in self.schemas:
                remove(self.spark, f"{self.root}/{table}/version_={before}")

    def read(self, name: str) -> DataFrame:
        """Current rows of all runs; versions that no run names are never listed among them."""
        schema = self.schemas[name]
        if not children(self.spark, f"{self.root}/_runs") or not children(self.spark, f"{self.root}/{name}"):
            return self.spark.createDataFrame([], schema)
        current = self.spark.read.schema("run string, version string").json(f"{self.root}/_runs").select(F.col("version").alias("version_"))
        rows = self.spark.read.schema(f"{schema}, version_ string").parquet(f"{self.root}/{name}")
        return rows.join(current, "version_", "left_semi").drop("version_")  # a row a run


def read_widened(spark: SparkSession, paths: Sequence[str], columns: Mapping[str, str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Versions of a table under one schema (name -> type): columns that a version lacks get their default there, else null.

    A null that a version holds stays one. Further columns of a version are left out.
    """
    defaults = defaults or {}

    def version(path: str) -> DataFrame:
        rows = spark.read.parquet(path)
        wide = {c: F.col(f"`{c}`") if c in rows.columns else F.lit(defaults.get(c)) for c in columns}
        return rows.select(*[value.cast(columns[c]).alias(c) for c, value in wide.items()])

    out = version(paths[0])
    for path in paths[1:]:
        out = out.unionByName(version(path))
    return out
