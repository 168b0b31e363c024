"""Landing: files to raw file and raw record rows, once each, or to the table of rejected files.

Small JSON files are read whole, a row each. Large ones are never a row: they
are read as segments that end at a closing brace, by byte ranges, and a
segment's place in the structure (inside a text or not, how deep) follows from
sums over the segments before it, so that a file is as many tasks as it has
ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.operators.keys import numbered_by
from veleta.scratch import file_system, keep

#: Files of so many bytes and more are read in segments.
SPLIT_ABOVE = 64 << 20
#: Segments whose digests make one digest of a large file's tree.
LEAVES = 1 << 16
UNKNOWN_SOURCE = "desconocido"
DAMAGED = "damaged JSON"
NO_RECORDS = "items is no list"
NO_LIST = "no list of objects"
_LAST = "last"
_ESCAPED = r"(?s)\\."
_ITEMS = r'"items"\s*:\s*\['


def relative(spark: SparkSession, path: Column, root: str) -> Column:
    """Path under the root folder, whatever characters either holds; Spark gives paths as URIs."""
    fs, at = file_system(spark, root)
    whole = fs.makeQualified(at).toString().rstrip("/")
    bare = F.regexp_replace(path, "^([a-z][a-z0-9+.-]*):/+", "$1:/")  # file:/x and file:///x are one
    prefix = whole.split(":", 1)[0] + ":/" + whole.split(":", 1)[1].lstrip("/") + "/"
    return F.when(F.startswith(bare, F.lit(prefix)), F.substring(bare, len(prefix) + 1, 1 << 20)).otherwise(path)


def source_of(ruta: Column) -> Column:
    """The first folder of a path; a file outside any has an unknown source."""
    return F.when(F.contains(ruta, F.lit("/")), F.split_part(ruta, F.lit("/"), F.lit(1))).otherwise(UNKNOWN_SOURCE)


def _in_sources(rows: DataFrame, sources: Sequence[str] | None) -> DataFrame:
    return rows if sources is None else rows.filter(F.col("fuente").isin(*sources))


def _listed(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.withColumn("ruta", relative(spark, F.col("path"), root)).withColumn("fuente", source_of(F.col("ruta")))


def _decoded(path: Column) -> Column:
    """A path as it is written: the metadata of text files have it as a URI."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def json_records(files: DataFrame) -> DataFrame:
    """Records of JSON files: an envelope with `items`, a list, or one object; as JSON text with their place.

    A file without records has one row without a place; a file that cannot be
    read has one with the reason.
    """
    text = F.try_validate_utf8(F.col("content").cast("string"))
    # the parser stops after the first value: one that is followed by more is no longer the first of these two
    both = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_LAST}"]'))), "$", "array<variant>")
    one = (F.size(both) == 2) & (F.try_variant_get(both[1], "$", "string") == _LAST)
    value = F.when(one, both[0])
    kind = F.schema_of_variant(value)
    items = F.variant_get(value, "$.items", "variant")
    has_items = F.startswith(kind, F.lit("OBJECT")) & F.array_contains(F.json_object_keys(text), "items")
    listed = (
        F.when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(value, "$", "array<variant>"))
        .when(has_items, F.try_variant_get(value, "$.items", "array<variant>"))
        .when(F.startswith(kind, F.lit("OBJECT")), F.array(value))
        .otherwise(F.array().cast("array<variant>"))
    )
    reason = F.when(value.isNull(), DAMAGED).when(has_items & (items.isNull() | ~F.startswith(F.schema_of_variant(items), F.lit("ARRAY"))), NO_RECORDS)
    rows = files.select(*[c for c in files.columns if c != "content"], reason.alias("reason"), F.when(reason.isNull(), listed).alias("listed_"))
    exploded = rows.select(*[c for c in rows.columns if c != "listed_"], F.posexplode_outer("listed_").alias("place", "v"))
    return exploded.withColumn("raw_data", F.to_json("v")).drop("v")


# Segments: the text up to a closing brace, without it.


def _outside(text: Column, inside: Column) -> Column:
    """What of a piece of JSON is outside texts in quotes, if it begins inside one or not."""
    return F.regexp_replace(F.concat(F.when(inside, '"').otherwise(""), F.regexp_replace(text, _ESCAPED, "")), r'(?s)"[^"]*("|\z)', "")


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _deeper(outside: Column) -> Column:
    return _count(outside, "{[") - _count(outside, "}]")


def _prefix(segments: DataFrame, value: str, name: str) -> DataFrame:
    """The sum of a column over all segments of the file before this one: within its range, and over the ranges before."""
    at = W.partitionBy("ruta", "block").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    totals = segments.groupBy("ruta", "block").agg(F.sum(value).alias("total_"))  # a row for each range
    over = W.partitionBy("ruta").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("ruta", "block", F.coalesce(F.sum("total_").over(over), F.lit(0)).alias("before_"))
    return segments.withColumn("own_", F.coalesce(F.sum(value).over(at), F.lit(0))).join(before, ["ruta", "block"]).withColumn(name, F.col("own_") + F.col("before_")).drop("own_", "before_")


def _segments(spark: SparkSession, root: str, pattern: str, least: int) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "}").text(root)
    return text.filter(F.col("_metadata.file_size") >= least).select(
        relative(spark, _decoded(F.col("_metadata.file_path")), root).alias("ruta"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modificado"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def segments(spark: SparkSession, root: str, pattern: str = "*", least: int = SPLIT_ABOVE) -> DataFrame:
    """Segments of the files of at least `least` bytes, with their place in the file and in its structure.

    `before` and `after`: how deep the segment begins and ends, its closing
    brace counted; `inside`: whether it begins inside a text in quotes.
    """
    rows = _segments(spark, root, pattern, least)
    rows = keep(spark, rows.withColumns({"quotes": _count(F.regexp_replace("value", _ESCAPED, ""), '"'), "size": F.octet_length("value") + 1}), "segments")
    # the last piece of a file is a segment without a brace, unless the file ends with one
    ends = rows.groupBy("ruta").agg(F.max(F.struct("block", "seq")).alias("last_"), (F.sum("size") > F.max("bytes")).alias("open_"))
    rows = _prefix(rows, "quotes", "quotes_before").join(ends, "ruta")
    inside = F.col("quotes_before") % 2 == 1
    closes = ~(F.col("open_") & (F.struct("block", "seq") == F.col("last_"))) & ((F.col("quotes_before") + F.col("quotes")) % 2 == 0)
    rows = rows.withColumns({"inside": inside, "outside": _outside(F.col("value"), inside), "closes": closes})
    rows = rows.withColumn("deeper", _deeper(F.col("outside")) - F.col("closes").cast("int")).drop("last_", "open_", "quotes_before")
    rows = _prefix(keep(spark, rows, "segment-depths"), "deeper", "before")
    return rows.withColumn("after", F.col("before") + F.col("deeper"))


def split_records(spark: SparkSession, root: str, pattern: str = "*", sources: Sequence[str] | None = None, least: int = SPLIT_ABOVE) -> DataFrame:
    """The rows of `json_records` for large files: lists of objects, bare or as the `items` of an envelope.

    Every object is parsed; of the rest of an envelope it is only checked that
    its brackets and texts are closed. The digest of a file is one over digests
    of `LEAVES` segments each, for a plain SHA-256 is one chain over all bytes.
    """
    rows = keep(spark, segments(spark, root, pattern, least), "structure")
    at = F.struct("block", "seq")
    # where the list begins: at the start of the file, or behind `items` in the outermost object
    found = F.regexp_instr("value", F.lit(_ITEMS))
    ahead = F.substring("value", F.lit(1), found - 1)
    marked = rows.filter(found > 0).filter(F.col("before") + _deeper(_outside(ahead, F.col("inside"))) == 1)
    marked = marked.groupBy("ruta").agg(F.min(at).alias("mark"), F.min_by(F.regexp_extract("value", _ITEMS + r"\s*(\]?)", 1), at).alias("mark_end"))
    first = F.min_by(F.regexp_replace(F.regexp_extract("value", r"^\s*\S\s*\S?", 0), r"\s", ""), at)
    whole = rows.groupBy("ruta").agg(
        F.min(at).alias("first"), first.alias("head"), F.max_by("outside", at).alias("tail"), F.sum("deeper").alias("rest"), F.sum("quotes").alias("marks"),
        F.bool_and(F.is_valid_utf8("value")).alias("valid"), F.max("bytes").alias("bytes"), F.max("modificado").alias("modificado"),
    )
    listed = F.startswith(F.col("head"), F.lit("["))
    files = whole.join(marked, "ruta", "left").select(
        "*",
        F.when(listed, 1).when(F.col("mark").isNotNull(), 2).alias("level"),
        F.when(listed, F.col("first")).otherwise(F.col("mark")).alias("start"),
        F.when(listed, F.col("head") == "[]").otherwise(F.col("mark_end") == "]").alias("none"),
    )
    files = keep(spark, files, "split-files")
    rows = rows.join(files.filter("not none").select("ruta", "level", "start"), "ruta").filter(at >= F.col("start"))
    ended = (at > F.col("start")) & (F.col("before") == F.col("level")) & F.col("outside").rlike(r"^\s*\]")
    ends = keep(spark, rows.filter(ended).groupBy("ruta").agg(F.min(at).alias("end")), "ends")
    rows = rows.join(ends, "ruta").filter(at < F.col("end"))
    rows = rows.withColumn("done", (F.col("closes") & (F.col("after") == F.col("level"))).cast("int"))
    # only the last piece of a file has no brace, and that one is behind the end of the list
    rows = rows.select("ruta", "block", "seq", F.concat("value", F.lit("}")).alias("text"), "done", F.when(at == F.col("start"), F.col("level")).alias("opens"))
    rows = _prefix(keep(spark, rows, "listed"), "done", "place")
    pieces = F.sort_array(F.collect_list(F.struct("block", "seq", "text", "opens")))  # of one object
    texts = rows.groupBy("ruta", "place").agg(pieces.alias("p"))
    opens = F.col("p")[0]["opens"]
    opener = F.when(opens == 1, r"(?s)^\s*\[\s*").when(opens == 2, "(?s)^.*?" + _ITEMS + r"\s*").otherwise(r"(?s)^\s*,\s*")
    texts = texts.select("ruta", "place", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"), opener.alias("opener"))
    cut = F.regexp_replace("text", F.col("opener"), F.lit(""))
    value = F.when(F.rlike(F.col("text"), F.col("opener")) & F.startswith(cut, F.lit("{")), F.try_parse_json(cut))
    records = keep(spark, texts.select("ruta", F.col("place").cast("int").alias("place"), F.to_json(value).alias("raw_data")), "objects")
    bad = records.groupBy("ruta").agg(F.bool_or(F.col("raw_data").isNull()).alias("bad"))
    files = files.join(ends, "ruta", "left").join(bad, "ruta", "left").join(_tree_digests(spark, root, pattern, least), "ruta")
    open_ = (F.col("rest") != 0) | (F.col("marks") % 2 != 0) | ~F.col("valid")
    cut_off = ~F.col("none") & F.col("end").isNull() | (F.col("level") == 1) & ~F.col("none") & ~F.col("tail").rlike(r"^\s*\]\s*\z")
    reason = F.when(open_ | F.coalesce("bad", F.lit(False)), DAMAGED).when(F.col("level").isNull(), NO_LIST).when(cut_off, DAMAGED)
    files = _in_sources(files.select("ruta", "bytes", "modificado", "hash_sha256", source_of(F.col("ruta")).alias("fuente"), reason.alias("reason")), sources)
    good = files.filter("reason is null").join(records, "ruta", "left")
    return good.unionByName(files.filter("reason is not null"), allowMissingColumns=True)


def _tree_digests(spark: SparkSession, root: str, pattern: str, least: int) -> DataFrame:
    rows = _segments(spark, root, pattern, least).select("ruta", "block", "seq", F.sha2("value", 256).alias("digest"), F.lit(1).alias("one"))
    numbered = _prefix(keep(spark, rows, "leaves"), "one", "nth")
    joined = lambda order: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "digest"))), lambda x: x["digest"]), ""), 256)
    leaves = numbered.groupBy("ruta", F.floor(F.col("nth") / LEAVES).alias("leaf")).agg(joined("nth").alias("digest"))
    return leaves.groupBy("ruta").agg(joined("leaf").alias("hash_sha256"))


def read_json(spark: SparkSession, root: str, pattern: str = "*", sources: Sequence[str] | None = None, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Records of the JSON files of a folder, read and parsed once: file columns, place, raw_data, and the reason of files that are none."""
    listed = _in_sources(_listed(spark, root, pattern).filter(F.col("length") < split_above), sources)
    files = listed.select("ruta", F.col("length").alias("bytes"), F.col("modificationTime").alias("modificado"), F.sha2("content", 256).alias("hash_sha256"), "content", "fuente")
    small = json_records(files)
    some = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).filter(F.col("length") >= split_above)
    if not some.select("path").limit(1).count():
        return keep(spark, small, "read")
    return keep(spark, small.unionByName(split_records(spark, root, pattern, sources, split_above).select(*small.columns)), "read")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files as JSON text; empty fields are null, times are ISO texts."""
    rows = spark.read.csv(path, header=True, inferSchema=True, nanValue="NaN")
    iso = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if t == "timestamp" else F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes]
    return rows.select(*iso).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("raw_data"))


def projected(spark: SparkSession, paths: Mapping[str, str], columns: Mapping[str, str], name: str) -> DataFrame:
    """Only the given columns (name -> type) of an optional Parquet table; an empty typed one where it is missing."""
    if not paths.get(name):
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items()))
    return spark.read.parquet(paths[name]).select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])


def new_files(files: DataFrame, landed: DataFrame) -> DataFrame:
    """Files whose content has not been landed; of several with the same content the one with the smallest path."""
    chosen = files.groupBy("hash_sha256").agg(F.min("ruta").alias("ruta")).join(landed.select("hash_sha256"), "hash_sha256", "left_anti")
    return files.join(chosen.select("ruta"), "ruta", "left_semi")


def land(records: DataFrame, landed: DataFrame, run_id: str, kind: str = "json") -> tuple[DataFrame, DataFrame, DataFrame]:
    """File and record rows to append, and rejected files, of the rows of `read_json`.

    A file lands whole or not at all: what cannot be read has a row among the
    rejected ones and none among the files, so that it is tried again next time.
    Identifiers go on after the greatest landed one.
    """
    file_columns = ["ruta", "fuente", "bytes", "hash_sha256"]
    files = records.groupBy(*file_columns).agg(
        F.count("place").alias("registros"), F.max(F.when(F.col("place") == 0, F.size(F.json_object_keys("raw_data")))).alias("columnas"), F.max("reason").alias("reason")
    )
    files = keep(records.sparkSession, files, "files")
    fresh = new_files(files.filter("reason is null").drop("reason"), landed)
    top = landed.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top_"))
    numbered = numbered_by(fresh, ["ruta"], "place_").join(top)
    file_rows = numbered.select(
        (F.col("top_") + F.col("place_")).cast("long").alias("id"),
        "fuente",
        F.lit(kind).alias("tipo_fuente"),
        "ruta",
        F.col("registros").cast("long").alias("registros"),
        F.coalesce("columnas", F.lit(0)).cast("int").alias("columnas"),
        "bytes",
        "hash_sha256",
        F.current_timestamp().alias("fecha_carga"),
        F.lit(run_id).alias("run_id"),
    )
    file_rows = keep(records.sparkSession, file_rows, "landed-files")
    # a record's identifier holds its file and place, so that files number theirs independently
    record_rows = records.filter("place is not null").join(file_rows.select("ruta", F.col("id").alias("raw_file_id")), "ruta").select(
        (F.col("raw_file_id") * (1 << 32) + F.col("place")).alias("id"), "raw_file_id", "raw_data", F.lit(run_id).alias("run_id")
    )
    rejected = files.filter("reason is not null").select("ruta", "fuente", "bytes", "hash_sha256", "reason", F.current_timestamp().alias("fecha"), F.lit(run_id).alias("run_id"))
    return file_rows, record_rows, rejected


def inventory(files: DataFrame, records: DataFrame) -> DataFrame:
    """Declared against landed records of each file."""
    loaded = records.groupBy("raw_file_id").agg(F.count(F.lit(1)).alias("cargados"))
    rows = files.join(loaded, files["id"] == F.col("raw_file_id"), "left")
    return rows.select(files["id"], "ruta", "registros", F.coalesce("cargados", F.lit(0)).alias("cargados"), (F.col("registros") - F.coalesce("cargados", F.lit(0))).alias("diferencia"))


def records_of(records: DataFrame, files: DataFrame, pending: DataFrame) -> DataFrame:
    """Raw records with their file's data, of the pending files."""
    f = files.join(pending.select("id"), "id", "left_semi").select(
        F.col("id").alias("raw_file_id"), "fuente", "tipo_fuente", F.col("fecha_carga").alias("fecha_carga_raw")
    )
    return records.withColumnRenamed("id", "raw_record_id").drop("run_id").join(f, "raw_file_id")


def parsed(records: DataFrame, schema: str) -> DataFrame:
    """Fields of one source's JSON records, beside the lineage columns."""
    kept = [c for c in records.columns if c != "raw_data"]
    return records.select(*kept, F.from_json("raw_data", schema, {"mode": "PERMISSIVE"}).alias("r_")).select(*[c for c in kept if c != "fuente"], "r_.*")
