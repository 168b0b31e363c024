"""Newest row per key, upserts, ledgers and stable surrogate keys.

Parquet tables know no MERGE, so an upsert is a function from the old and the
new rows to the next version of the table; callers write it to a new place or
overwrite partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.scratch import file_system, keep, keep_parts, shuffles_removed


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    ranked = df.withColumn("rn_", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("rn_ = 1").drop("rn_")


def newest_by_aggregate(df: DataFrame, keys: Sequence[str], version: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """The newest row of each key by `max_by`: combined before the shuffle, so a hot key moves one row a task."""
    order = F.struct(*version)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*version, *payload), order).alias("r_"))
    return picked.select(*keys, "r_.*")


#: Identity of an observation; missing parts count as 'N/A'.
SNAPSHOT_KEY = ("fuente", "plataforma", "id_origen_registro", "nombre_agente")


def identity(df: DataFrame, keys: Sequence[str] = SNAPSHOT_KEY) -> list[Column]:
    """Key parts as text, missing ones as 'N/A'."""
    return [F.coalesce(F.col(k).cast("string"), F.lit("N/A")).alias(f"key_{i}_") for i, k in enumerate(keys)]


def _newest(df: DataFrame, keys: Sequence[Column], version: Sequence[Column]) -> DataFrame:
    """The row of the greatest version of each key, nulls lowest; combined before the shuffle."""
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*version)).alias("row_"))
    return picked.select("row_.*")


def snapshot_dedup(df: DataFrame, keys: Sequence[str] = SNAPSHOT_KEY, version: Sequence[str] = ("fecha_evento", "raw_file_id", "raw_record_id")) -> DataFrame:
    """One row per identity: the greatest version, nulls lowest."""
    return _newest(df, identity(df, keys), [F.col(v) for v in version])


def snapshot_removed(df: DataFrame, keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """One row: how many rows `snapshot_dedup` takes out."""
    return df.groupBy(*identity(df, keys)).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("eliminados"))


def upsert_newest(old: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Old and new rows, the newest version of each identity; on equal versions the old row stays."""
    both = old.withColumn("is_old_", F.lit(1)).unionByName(new.withColumn("is_old_", F.lit(0)), allowMissingColumns=True)
    return _newest(both, identity(both, keys), [*map(F.col, version), F.col("is_old_")]).drop("is_old_")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of records that share a key, the last one in the given order; the key is the first of `keys` that is not empty."""
    key = F.coalesce(*[F.nullif(F.trim(F.col(k).cast("string")), F.lit("")) for k in keys])
    return _newest(df.withColumn("key_", key), [F.col("key_")], [F.col(c) for c in order]).drop("key_")


def pending(available: DataFrame, processed: DataFrame, key: str, version_col: str, version: str, rebuild: bool = False) -> DataFrame:
    """Files not processed yet; all of them for a rebuild. A stored version that differs is an error without one."""
    if rebuild:
        return available
    if processed.filter(F.col(version_col) != version).limit(1).count():
        raise ValueError("files were processed by another version; a rebuild is needed")
    return available.join(processed.select(key), key, "left_anti")


def processed_of(processed: DataFrame, files: DataFrame, sources: Sequence[str] | None = None, key: str = "file_id") -> DataFrame:
    """Ledger rows of files that are still landed, of the given sources."""
    wanted = files if sources is None else files.filter(F.col("fuente").isin(*sources))
    return processed.join(wanted.select(F.col("id").alias(key)), key, "left_semi")


def processed_counts(files: DataFrame, rows: DataFrame, version: str, run_id: str) -> DataFrame:
    """A ledger row for each processed file, with the number of rows that came of it, 0 where none did."""
    counts = rows.groupBy("raw_file_id").agg(F.count(F.lit(1)).alias("n_"))
    joined = files.select(F.col("id").alias("file_id")).join(counts, F.col("file_id") == F.col("raw_file_id"), "left")
    return joined.select("file_id", F.lit(version).alias("transformation_version"), F.lit(run_id).alias("run_id"), F.coalesce("n_", F.lit(0)).cast("long").alias("records_processed"))


def ledger_upsert(old: DataFrame, new: DataFrame, key: str = "file_id") -> DataFrame:
    """The next version of the ledger: new rows take the place of old ones of the same file."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


class RepeatedKey(ValueError):
    """A table holds a key twice that must be unique."""


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` itself, once it is proven that no key occurs twice: a count over 64-bit digests of the keys, and over the keys where a digest repeats."""
    with shuffles_removed(df.sparkSession):
        if len(keys) > 1:
            digests = df.groupBy(F.xxhash64(*keys).alias("digest_")).agg(F.count(F.lit(1)).alias("n_")).filter("n_ > 1")
            if digests.first() is None:
                return df
            df_ = df.join(digests.select("digest_"), F.xxhash64(*keys) == F.col("digest_"), "left_semi")
        else:
            df_ = df
        twice = df_.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_")).filter("n_ > 1").first()
    if twice is not None:
        raise RepeatedKey(f"{twice['n_']} rows of {', '.join(f'{k}={twice[k]}' for k in keys)}")
    return df


def one_per_key(new: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Of new rows that share a key the one of the greatest version; of equal versions the greatest row, so that each run takes the same."""
    rest = [c for c in new.columns if c not in keys and c not in version]
    if not rest and not version:
        return new.dropDuplicates(list(keys))
    # a row's version and rest are all but its key: their maximum is the row, and a shuffle carries it once
    return new.groupBy(*keys).agg(F.max(F.struct(*version, *rest)).alias("row_")).select(*keys, "row_.*").select(*new.columns)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    same = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(Column.__and__, same)


def _top(old: DataFrame, key: str) -> int:
    return old.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("top")).first().top


def with_surrogate_keys(new: DataFrame, old: DataFrame | None, natural: Sequence[str], key: str, version: Sequence[str] = ()) -> DataFrame:
    """SCD-1 upsert of a dimension: known members keep their key, new ones continue after the greatest.

    Attributes come from `new` where the member is there, absence deletes
    nothing. Of several new rows of one member the one of the greatest version
    counts; the columns of the version are no attributes. New keys follow the
    order of the natural key. `old` holds each member once.
    """
    attributes = [c for c in new.columns if c not in (*natural, *version)]
    new = keep(new.sparkSession, one_per_key(new, natural, version).select(*natural, *attributes), "members")
    if old is None:
        return numbered_by(new, natural, key).select(*natural, key, *attributes)
    fresh = new.alias("n").join(old.alias("o"), _same("n", "o", natural), "left_anti")
    numbered = numbered_by(fresh, natural, key).withColumn(key, F.col(key) + _top(old, key))
    stays = old.alias("o").join(new.withColumn("in_new_", F.lit(True)).alias("n"), _same("n", "o", natural), "left").select(
        *[F.col(f"o.{c}").alias(c) for c in natural],
        F.col(f"o.{key}").cast("long").alias(key),
        *[F.when(F.col("in_new_"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in attributes],
    )
    return stays.unionByName(numbered)


#: Rows that one task may number.
FEW_ROWS = 100_000
#: Rows of a slice, the part of a large table that is shuffled at a time; how many there are at most, and sampled keys for each.
SLICE_ROWS, MOST_SLICES, SAMPLED = 20_000_000, 64, 1_000


def slices_of(rows: int) -> int:
    return max(1, min(MOST_SLICES, -(-rows // SLICE_ROWS)))


def _slice(df: DataFrame, order: Sequence[str], rows: int) -> Column | None:
    """The number of a row's slice, following the order; none where one slice does. Slices are cut at sampled keys."""
    n = slices_of(rows)
    if n == 1:
        return None
    key = F.struct(*order)
    sample = df.select(key.alias("key_")).sample(min(1.0, n * SAMPLED / rows), 7).agg(F.sort_array(F.collect_list("key_")).alias("keys")).first()["keys"]
    cuts = dict.fromkeys(sample[len(sample) * i // n] for i in range(1, n) if sample)
    value = lambda cut: F.struct(*[F.lit(cut[c]).cast(df.schema[c].dataType).alias(c) for c in order])
    return sum(((key >= value(cut)).cast("int") for cut in cuts), F.lit(0)) if cuts else None


def _in_ranges(df: DataFrame, order: Sequence[str], version: Sequence[str] | None, rows: int) -> DataFrame:
    """The rows by ranges of the order, sorted, with their slice and place; of equal keys the newest one, where a version is given."""

    def ranged(part: DataFrame, i: int) -> DataFrame:
        one = part if version is None else one_per_key(part, order, version)
        # such an identifier is the number of the range and, in its lower 33 bits, the place in it
        return one.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("slice_", F.lit(i)).withColumn("at_", F.monotonically_increasing_id())

    spark, number = df.sparkSession, _slice(df, order, rows)
    if number is None:
        return keep_parts(spark, [ranged(df, 0)], "numbered")
    dealt = keep_parts(spark, [df.withColumn("slice_", number)], "slices", ("slice_",))

    def parts() -> Iterator[DataFrame]:
        for i in sorted(r["slice_"] for r in dealt.select("slice_").distinct().collect()):
            yield ranged(dealt.filter(F.col("slice_") == i).drop("slice_"), i)
            fs, first = file_system(spark, dealt.inputFiles()[0])
            fs.delete(file_system(spark, f"{first.getParent().getParent()}/slice_={i}")[1], True)

    return keep_parts(spark, parts(), "numbered")


def numbered_by(df: DataFrame, order: Sequence[str], name: str, version: Sequence[str] | None = None, rows: int = 0) -> DataFrame:
    """1 .. n in the given order without one task for all rows, unless there are at most `FEW_ROWS`.

    The rows are dealt by ranges, sorted and numbered inside each range, and
    written once to the shared folder; sizes of ranges and rows are read from
    there, so that both see the same ranges. Where `rows` tells that there are
    many, one slice of the order after the other is shuffled. With a version,
    of rows that are equal in the order the newest one counts.
    """
    ranged = _in_ranges(df, order, version, rows)
    if ranged.count() <= FEW_ROWS:
        return ranged.withColumn(name, F.row_number().over(W.orderBy("slice_", "at_")).cast("long")).drop("slice_", "at_")
    part = F.shiftright("at_", 33)
    sizes = ranged.groupBy("slice_", part.alias("part_")).agg(F.count(F.lit(1)).alias("size_"))  # one row per range
    before = sizes.withColumn("before_", F.coalesce(F.sum("size_").over(W.orderBy("slice_", "part_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    before = keep(df.sparkSession, before.select("slice_", "part_", "before_"), "ranges")  # so small a file is broadcast
    place = F.col("at_").bitwiseAND(F.lit((1 << 33) - 1))
    joined = ranged.withColumn("part_", part).join(before, ["slice_", "part_"])
    return joined.withColumn(name, (F.col("before_") + place + 1).cast("long")).drop("slice_", "part_", "at_", "before_")


def upsert_fact(new: DataFrame, old: DataFrame | None, grain: Sequence[str], key: str, lineage: str, version: Sequence[str] = (), rows: int = 0) -> DataFrame:
    """Fact upsert on its grain: key and first lineage stay, everything else is refreshed.

    Of several new rows of one grain the one of the greatest version counts, so
    that the result holds every grain once, if `old` does; `unique` proves it.
    `rows` tells about how many new rows there are, for slices of a large table.
    """
    if old is None:
        return numbered_by(new, grain, key, version, rows).select(key, *new.columns)
    new = keep_parts(new.sparkSession, [one_per_key(new, grain, version)], "new-facts")
    measures = [c for c in new.columns if c not in grain and c != lineage]
    stays = old.alias("o").join(new.withColumn("in_new_", F.lit(True)).alias("n"), _same("n", "o", grain), "left").select(
        F.col(f"o.{key}").cast("long").alias(key),
        *[F.col(f"o.{c}").alias(c) for c in (*grain, lineage)],
        *[F.when(F.col("in_new_"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in measures],
    )
    fresh = new.alias("n").join(old.alias("o"), _same("n", "o", grain), "left_anti")
    return stays.unionByName(numbered_by(fresh, grain, key, rows=rows).withColumn(key, F.col(key) + _top(old, key)))


def retire(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows that do not come from a retired source."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def without_orphans(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Dimension members that a fact still uses."""
    return dim.join(fact.select(key).distinct(), key, "left_semi")


def consolidate(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """New rows, and old rows whose key is not among the new ones (null keys kept)."""
    legacy = old.filter(F.col(key).isNotNull()).join(new.select(key), key, "left_anti").unionByName(old.filter(F.col(key).isNull()))
    return new.unionByName(legacy, allowMissingColumns=True)


def lost_keys(result: DataFrame, sources: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys of the sources that the result does not hold; a consolidation must leave none."""
    every = sources[0].select(key)
    for df in sources[1:]:
        every = every.unionByName(df.select(key))
    return every.filter(F.col(key).isNotNull()).distinct().join(result.select(key), key, "left_anti")


def key_report(df: DataFrame, key: str) -> DataFrame:
    """rows, distinct keys and null keys; duplicates are rows - distinct - nulls."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.count_if(F.col(key).isNull()).alias("null_keys")
    )
