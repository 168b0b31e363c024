"""Best-fit packing by sum of squares.

A document becomes a row of token identifiers and is cut into pieces of at
most `capacity`; full pieces fill a sequence of their own. Every other piece
goes, longest first, to where the sum over residual gaps of the squared number
of open sequences with that gap becomes smallest.

Texts are tokenized once; only piece lengths and check sums are shuffled, never
tokens. Pieces that are not full are packed in groups of bounded size (a hash of
document and piece, dealt out by ranges of group numbers, so that each group is
a task), so work grows with the input and no task sees all pieces. What the
groups leave in sequences that are not filled is packed again, in fewer
groups, so that the waste of a group does not add up.

Defined results: null text counts as empty; an empty text is one piece that
holds the closing identifier alone; repeated rows with the same identifier are
packed as documents of their own; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm.cache import Memo
from veleta.llm.shared import forget, keep, small_batches
from veleta.llm.text import distinct_texts, parts

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs at a time.
GROUP_PIECES = 16_384
#: Sequences filled less than this after the first pass are packed again.
WELL_FILLED = CAPACITY - 8
#: Units whose identifiers a Python worker keeps, twice at most.
UNITS_KEPT = 200_000
#: What NFC leaves as it is and whose classes are known: ASCII and the letters of Latin-1 (without its signs).
PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: Units of the vocabulary's pre-tokenizer in lower-cased plain text, and the line feed that stands between chunks.
UNIT = re.compile("\n|'(?:[stmd]|re|ve|ll)|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\x09-\x0d\x20a-z0-9\xdf-\xf6\xf8-\xff]+")
#: Stands between chunks in a row of identifiers; no vocabulary is that large.
CUT_ID = 0xFFFFFFFF
CUT = CUT_ID.to_bytes(4, "little")


class WordTokenizer:
    """Identifiers of texts from those of their chunks (between spaces and line feeds), each distinct one tokenized once a call.

    The vocabulary's pre-tokenizer drops white space and never joins what it
    separates, so chunks are independent. A chunk of ASCII and Latin-1 letters
    alone is unchanged by NFC, so it is lower-cased and cut into the
    pre-tokenizer's units here, and a unit is tokenized once for all chunks that
    have it; new units go to the library in one call and are told apart by the
    end-of-word mark of their last token. Every other chunk goes to the library
    as it is.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.units, self.chunks = Memo(self._one, UNITS_KEPT), Memo(self._one)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _one(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _units(self, units: set[str]) -> dict[str, bytes]:
        """Identifiers of each unit; new ones are tokenized in one call."""
        known, new = self.units.known(units)
        if not new:
            return known
        ids = self._ids(" ".join(new))
        ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(ends) == len(new):
            ids = ids.tobytes()
            found = [ids[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]
        else:  # not to be told apart: one by one
            found = map(self._one, new)
        for unit, one in zip(new, found):
            known[unit] = one
            self.units.put(unit, one)
        return known

    def _plain(self, chunk: str) -> bool:
        return PLAIN.fullmatch(chunk) is not None and not any(m in chunk for m in self.marks)

    def _tokenize(self, joined: str) -> pa.LargeBinaryArray:
        """Identifiers of each chunk of a text that has chunks between line feeds."""
        other = {}
        if not self._plain(joined):
            chunks = joined.split("\n")
            other = {i: c for i, c in enumerate(chunks) if not self._plain(c)}
            joined = "\n".join("" if i in other else c for i, c in enumerate(chunks))
        units = UNIT.findall(joined.lower() + "\n")
        known = self._units(set(units) - {"\n"}) | {"\n": CUT}
        found = np.frombuffer(b"".join(map(known.__getitem__, units)), "<u4")
        cuts = np.flatnonzero(found == CUT_ID)
        ends = 4 * (cuts - np.arange(len(cuts)))
        found = found[found != CUT_ID]
        plain = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(found)])
        if not other:
            return plain
        at = np.arange(len(cuts))
        at[list(other)] = len(cuts) + np.arange(len(other))
        return pa.concat_arrays([plain, pa.array([self.chunks[c] for c in other.values()], pa.large_binary())]).take(pa.array(at))

    def encode(self, texts: pa.Array | list[str]) -> list[memoryview]:
        """Identifiers of each text, as little-endian unsigned 32-bit integers."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        chunks, codes = distinct_texts(split.flatten())
        ids = self._tokenize(chunks.decode()).take(pa.array(codes))
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int64)[ids.offset : ids.offset + len(ids) + 1]
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        data = memoryview(data or b"")
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


_PIECES = pa.schema([("doc_id", pa.int64()), ("copy", pa.string()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PIECE_FIELDS = "doc_id long, copy string, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, copy (a random mark of the row), piece, start, length, ids_crc32."""
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            for part in parts(batch, 2):
                rows = []
                for doc_id, copy, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), tokenizer.encode(part.column(2))):
                    ids = memoryview(bytes(ids) + end)
                    n = len(ids) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        length = min(capacity, n - start)
                        rows.append((doc_id, copy, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECES.types)], schema=_PIECES)

    rows = docs.select(F.col(id_col).cast("long"), F.uuid().alias("copy"), F.coalesce(text_col, F.lit("")))
    return rows.mapInArrow(run, PIECE_FIELDS)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, in the given order.

    `open_[g]` counts open sequences with gap g. Moving one from gap g to
    g - s changes the sum of squares by 2 * (open_[g - s] - open_[g]) + 2, or by
    1 - 2 * open_[g] where it gets full; a new sequence by 2 * open_[capacity - s] + 1.
    """
    open_ = np.zeros(capacity + 1, np.int64)
    with_gap: dict[int, list[int]] = defaultdict(list)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    far, made = np.int64(1) << 60, 0
    for i, s in enumerate(lengths.tolist()):
        if s == capacity:
            sequence[i], offset[i], made = made, 0, made + 1
            continue
        here = open_[s:capacity]  # gaps s .. capacity - 1
        change = 2 * (open_[: capacity - s] - here) + 2
        change[0] -= 1  # a full sequence is no longer open, and open_[0] stays 0
        change[here == 0] = far
        best = int(change.argmin())
        if change[best] <= 2 * open_[capacity - s] + 1:
            gap = best + s
            number = with_gap[gap].pop()
            open_[gap] -= 1
        else:
            gap, number, made = capacity, made, made + 1
        sequence[i], offset[i] = number, capacity - gap
        if gap > s:
            open_[gap - s] += 1
            with_gap[gap - s].append(number)
    return sequence, offset


def _pack_groups(rows: DataFrame, n_groups: int, capacity: int, level: int) -> DataFrame:
    """`rows` with group_, sequence_ and offset_; each group is packed by itself."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "copy", "piece"], ascending=[False, True, True, True], kind="stable")
        group["sequence_"], group["offset_"] = sum_of_squares(group["length"].to_numpy(), capacity)
        group["filled_"] = group.groupby("sequence_")["length"].transform("sum")
        return group

    key = F.pmod(F.xxhash64("doc_id", "copy", "piece", F.lit(level)), F.lit(n_groups)).cast("int")
    schema = f"{PIECE_FIELDS}, group_ int, sequence_ long, offset_ long, filled_ long"
    return rows.withColumn("group_", key).repartitionByRange(n_groups, "group_").groupBy("group_").applyInPandas(pack, schema)


def pack(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with sequence_id and offset; no sequence is longer than `capacity`."""
    small_batches(spark)
    cut = keep(spark, pieces(docs, path, capacity, id_col, text_col), "pieces")
    full, partial = cut.filter(F.col("length") == capacity), cut.filter(F.col("length") < capacity)
    n_groups = max(1, -(-partial.count() // GROUP_PIECES))
    first = keep(spark, _pack_groups(partial, n_groups, capacity, 0), "packed")
    well = F.col("filled_") >= capacity - (CAPACITY - WELL_FILLED)
    loose = first.filter(~well).select(*[x.split()[0] for x in PIECE_FIELDS.split(", ")])
    n_again = max(1, -(-loose.count() // GROUP_PIECES))
    second = _pack_groups(loose, n_again, capacity, 1)

    def numbered(packed: DataFrame, number, offset) -> DataFrame:
        return packed.select("doc_id", "piece", "start", "length", "ids_crc32", number.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))

    # a sequence number from level, group and place (places stay far below 2^31); full pieces have the numbers below 0
    place = F.col("group_").cast("long") * F.lit(1 << 31) + F.col("sequence_")
    out = numbered(first.filter(well), place, F.col("offset_")).unionByName(numbered(second, place + F.lit(1 << 62), F.col("offset_")))
    out = keep(spark, out.unionByName(numbered(full, -1 - F.monotonically_increasing_id(), F.lit(0))), "sequences")
    forget(spark, cut, first)
    return out
