"""Shared text conventions of the corpus operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: str.translate table that lower-cases A-Z only.
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: Column) -> Column:
    """Array of words of a text column; empty for null, empty or blank text."""
    text = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":  # one plain separator: splitting at it needs no pattern matching
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def count_chars(text: Column, chars: str) -> Column:
    """Occurrences of the given ASCII characters."""
    left = text
    for c in chars:
        left = F.replace(left, F.lit(c), F.lit(""))
    return (F.octet_length(text) - F.octet_length(left)).cast("long")


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body` as a bound variable."""
    return F.transform(F.array(value), body)[0]


def packed(df: DataFrame) -> Column:
    """All columns of `df` in one, so that names of our own cannot clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_texts(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[bytes]:
    """Texts of a column in UTF-8, null as empty, a bounded number of rows at a time."""
    for batch in batches:
        texts = batch.column(column)
        for at in range(0, len(texts), 256):
            for t in texts.slice(at, 256).cast(pa.binary()).to_pylist():
                yield t or b""


#: Rows and bytes of text that are split into words at a time.
PART_ROWS, PART_BYTES = 1000, 1 << 22


def parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of a bounded number of rows and bytes in `column`; a longer row is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    upto = np.append(0, np.cumsum(sizes, dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(upto, upto[at] + PART_BYTES, "right")) - 1
        end = min(max(end, at + 1), at + PART_ROWS, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def distinct_texts(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """Distinct strings without line feeds, in UTF-8 and joined by line feeds, and the number of each string among them."""
    found = texts.dictionary_encode()
    one = pa.ListArray.from_arrays(pa.array([0, len(found.dictionary)], pa.int32()), found.dictionary)
    return pc.binary_join(one, "\n")[0].as_buffer().to_pybytes(), found.indices.to_numpy()


def word_codes(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of texts (null as empty) as `byte_words` gives them, the number of each word among them, and where each text begins and ends."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    joined, codes = distinct_texts(split.flatten())
    words, bounds = joined.split(b"\n"), split.offsets.to_numpy()
    bounds = bounds - bounds[0] if len(bounds) else np.zeros(1, np.int32)
    if b"" in words:  # before the first and after the last space, and in an empty text
        empty = words.index(b"")
        bounds = np.append(0, np.cumsum(codes != empty))[bounds]
        codes = codes[codes != empty]
        codes = codes - (codes > empty)
        words.pop(empty)
    return words, codes, bounds


def byte_words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased: bytes know no white space and no letters but the ASCII ones."""
    return text.lower().split()


def string_array(words: list[bytes]) -> pa.Array:
    """Words of texts, cut at ASCII characters, as a string array."""
    return pa.array(words, pa.binary()).cast(pa.string(), safe=False)
