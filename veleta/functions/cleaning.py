"""Column expressions that clean, parse and fill values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.operators.quantiles import medians as exact_medians


def first_existing(df: DataFrame, columns: Sequence[str], default: object = None) -> Column:
    """The first of the columns that the schema has, whatever its values; else the default."""
    for c in columns:
        if c in df.columns:
            return F.col(c)
    return F.lit(default)


def first_non_null(df: DataFrame, columns: Sequence[str], default: object = None) -> Column:
    """Per row the first value that is not null among the columns that exist."""
    found = [F.col(c) for c in columns if c in df.columns]
    return F.coalesce(*found, F.lit(default)) if found else F.lit(default)


def number(column: Column, kind: str = "double", default: object = None) -> Column:
    """A number of a value, the default where it is none."""
    value = column.cast("string").try_cast("double")
    if kind != "double":
        value = F.when(F.isnan(value) | (F.abs(value) > 9e18), None).otherwise(value).cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default))


def joined_list(df: DataFrame, column: str) -> Column:
    """A list as text with commas, a scalar as it is."""
    if column not in df.columns:
        return F.lit(None).cast("string")
    kind = df.schema[column].dataType.typeName()
    return F.array_join(F.col(column), ", ") if kind == "array" else F.col(column).cast("string")


def nested(df: DataFrame, column: str, key: str) -> Column:
    """A field of a struct or map column, null where it is not there."""
    if column not in df.columns:
        return F.lit(None).cast("string")
    kind = df.schema[column].dataType
    if kind.typeName() == "struct" and key not in kind.fieldNames():
        return F.lit(None).cast("string")
    return F.col(column)[key].cast("string")


def record_hash(df: DataFrame) -> Column:
    """A stable identifier of a whole record."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])), 256)


def event_time(column: Column) -> Column:
    """Timestamp of a text: without a zone it is UTC, with one it is converted, junk is null."""
    return column.cast("string").try_cast("timestamp")


def dated(rows: DataFrame, event: str = "fecha_evento_raw", load: str = "fecha_carga_raw") -> DataFrame:
    """Event day, from the load time where the source has none (flagged); rows without either are dropped."""
    own, fallback = event_time(F.col(event)), event_time(F.col(load))
    out = rows.withColumn("own_", own).withColumn("fallback_", fallback)
    out = out.withColumn("fecha_evento", F.to_date(F.coalesce("own_", "fallback_")))
    out = out.withColumn("is_imputed_date", F.col("own_").isNull() & F.col("fallback_").isNotNull())
    return out.filter("fecha_evento is not null").drop("own_", "fallback_")


def dirty_number(column: Column) -> Column:
    """Whole number of a written figure: points and commas go first, k and m stand for zeros, blanks are 0."""
    text = F.lower(F.coalesce(column.cast("string"), F.lit("")))
    text = F.translate(text, ",.", "")
    text = F.replace(F.replace(text, F.lit("k"), F.lit("000")), F.lit("m"), F.lit("000000"))
    digits = F.nullif(F.regexp_replace(text, "[^0-9]", ""), F.lit(""))
    return F.when(F.lower(column.cast("string")) == "none", 0).otherwise(F.coalesce(digits.try_cast("bigint"), F.lit(0)))


# Names by a part that they contain, in order.
NAME_PARTS = (("copilot", "GitHub Copilot"), ("chatgpt", "ChatGPT"), ("gpt", "ChatGPT"), ("claude", "Claude"), ("cursor", "Cursor"), ("devin", "Devin"))


def title_case(text: Column) -> Column:
    """Letters after anything but a letter in upper case, all others in lower case."""
    chars = F.split(text, "")
    after_letter = lambda i: (i > 0) & F.get(chars, i - 1).rlike(r"\p{L}")
    return F.array_join(F.transform(chars, lambda c, i: F.when(after_letter(i), F.lower(c)).otherwise(F.upper(c))), "")


def standard_name(column: Column, parts: Sequence[tuple[str, str]] = NAME_PARTS) -> Column:
    text = F.trim(column)
    found = [F.when(F.contains(F.lower(text), F.lit(p)), F.lit(n)) for p, n in parts]
    return F.when(column.isNull(), F.lit("Desconocido")).otherwise(F.coalesce(*found, title_case(text)))


def impute(df: DataFrame, strategies: Mapping[str, str]) -> DataFrame:
    """Fill or drop nulls by column: drop, median, unknown or zero; columns that are not there are passed over."""
    medians = [c for c, s in strategies.items() if s == "median" and c in df.columns]
    out = df
    for c, strategy in strategies.items():
        if c not in df.columns:
            continue
        if strategy == "drop":
            out = out.dropna(subset=[c])
        elif strategy == "unknown":
            out = out.fillna("Desconocido", [c])
        elif strategy == "zero":
            out = out.fillna(0, [c])
    if medians:
        for c, middle in exact_medians(out, medians).items():
            out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(middle).cast("double")))
    return out


def clamped(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Text columns cut to their widths, without NUL characters."""
    return df.withColumns({c: F.substring(F.translate(F.col(c), "\u0000", ""), 1, n) for c, n in widths.items() if c in df.columns})


def index_to_max(df: DataFrame, column: str, group: str, name: str, digits: int = 2) -> DataFrame:
    """0..100 relative to the greatest value of the group (1 where that is 0); a large group stays distributed."""
    top = df.groupBy(F.col(group).alias("g_")).agg(F.max(column).alias("top_"))
    scaled = F.bround(F.col(column) / F.when(F.coalesce("top_", F.lit(0)) == 0, 1).otherwise(F.col("top_")) * 100.0, digits)
    return df.join(top, F.col(group).eqNullSafe(F.col("g_")), "left").withColumn(name, scaled).drop("g_", "top_")


def in_window(column: Column, start: str, end: str) -> Column:
    """Both ends included, by day."""
    return (column >= F.lit(start).cast("date")) & (column < F.date_add(F.lit(end).cast("date"), 1))


def year_slices(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar-year slices of each row's window, contiguous and clipped to its ends."""
    years = F.explode(F.sequence(F.year(start), F.year(end)))
    cut = rows.withColumn("year_", years)
    return cut.withColumns(
        {
            "slice_start": F.greatest(F.col(start), F.make_date("year_", F.lit(1), F.lit(1))),
            "slice_end": F.least(F.col(end), F.make_date("year_", F.lit(12), F.lit(31))),
        }
    ).drop("year_")
