"""Byte-level BPE encoding by forced-boundary splitting, and decoding.

A pair of bytes that no vocabulary token contains can never be inside a token,
so every such pair in a text is a certain cut: no merge crosses it, and the
fragments on both sides are encoded independently and concatenated. The
pattern of the vocabulary's pre-tokenizer gives the outer pieces, the forced
pairs cut those into fragments, and each distinct fragment is merged once per
worker and kept in a bounded memo.

Identifiers are kept as little-endian unsigned 32-bit integers in a binary
column. Defined results: null text encodes as an empty sequence and decodes to
an empty text; special tokens inside a text become their identifiers; repeated
rows and tied identifiers are encoded row by row; an empty table gives an
empty result; further columns of the input are dropped by `encode` and
`decode` except the identifier column.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.llm.cache import Memo
from veleta.llm.shared import small_batches

#: Fixed value: the pre-tokenizer pattern of byte-level vocabularies.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Fragments longer than this are merged with a heap.
SHORT = 48
#: More than any rank.
NONE = 1 << 62


def byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files, by the usual rule."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    found = {chr(b): b for b in own}
    for i, b in enumerate(b for b in range(256) if b not in own):
        found[chr(256 + i)] = b
    return found


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_chars()
        ids: dict[str, int] = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in token) if token not in self.special else token.encode()
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.byte_id = [ids[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])]
        #: (left << 32 | right) -> (rank << 32 | merged)
        self.merges = {ids[a] << 32 | ids[b]: rank << 32 | ids[a + b] for rank, (a, b) in enumerate(pairs)}
        inside = bytearray(1 << 16)  # byte pairs that some token contains
        for token in ids:
            if token not in self.special:
                b = [to_byte[c] for c in token]
                for x, y in zip(b, b[1:]):
                    inside[x << 8 | y] = 1
        self.inside = bytes(inside)
        self.piece = regex.compile(PIECE)
        self.split_special = regex.compile("|".join(f"({regex.escape(t)})" for t in self.special)) if self.special else None
        self.fragments = Memo(self._fragment, 100_000)
        self.pieces = Memo(self._piece, 200_000)

    def cut(self, body: bytes) -> list[bytes]:
        """Fragments between certain cuts."""
        inside, found, start = self.inside, [], 0
        for i in range(1, len(body)):
            if not inside[body[i - 1] << 8 | body[i]]:
                found.append(body[start:i])
                start = i
        found.append(body[start:])
        return found

    def _piece(self, piece: str) -> bytes:
        fragments = self.cut(piece.encode())
        if len(fragments) == 1:
            return self._fragment(fragments[0])
        return b"".join(map(self.fragments.__getitem__, fragments))

    def _fragment(self, fragment: bytes) -> bytes:
        parts = [self.byte_id[b] for b in fragment]
        return array("I", self._merge(parts) if len(parts) <= SHORT else self._merge_long(parts)).tobytes()

    def _merge(self, parts: list[int]) -> list[int]:
        """Merge the leftmost pair of lowest rank until no pair has one."""
        get = self.merges.get
        ranks = [get(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NONE:
            i = ranks.index(best)
            parts[i] = new = best & 0xFFFFFFFF
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(new << 32 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | new, NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in n log n steps: a heap of pairs over a linked list."""
        get, n = self.merges.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, parts[i], parts[i + 1]) for i in range(n - 1) if (m := get(parts[i] << 32 | parts[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            new = best & 0xFFFFFFFF
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := get(new << 32 | parts[k], NONE)) != NONE:
                    heapq.heappush(heap, (m, i, new, parts[k]))
            if (h := before[i]) >= 0 and (m := get(parts[h] << 32 | new, NONE)) != NONE:
                heapq.heappush(heap, (m, h, parts[h], new))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> bytes:
        if self.split_special is None or not any(t in text for t in self.special):
            return b"".join(map(self.pieces.__getitem__, self.piece.findall(text)))
        found = []
        for part in self.split_special.split(text):
            if part in self.special:
                found.append(self.special[part].to_bytes(4, "little"))
            elif part:
                found.extend(map(self.pieces.__getitem__, self.piece.findall(part)))
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this worker; read once."""
    return Vocabulary(path)


def by_value(kind: pa.DataType, function: Callable, names: list[str], most: int = 8 << 20):
    """mapInArrow function: column 0 passes, column 1 goes through `function`; batches of bounded bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = function()
        for batch in batches:
            ids, values = batch.column(0), batch.column(1)
            held, size, start = [], 0, 0
            for i in range(batch.num_rows):
                out = f(values[i].as_py())
                held.append(out)
                size += len(out)
                if size > most or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([ids.slice(start, i + 1 - start), pa.array(held, kind)], names=names)
                    held, size, start = [], 0, i + 1

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and `ids`, the token identifiers of the whole text."""
    name, kind = id_col, docs.schema[id_col].dataType.simpleString()
    run = by_value(pa.binary(), lambda: vocabulary(path).encode, [name, "ids"])
    rows = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"`{name}` {kind}, ids binary")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col and `text`, decoded from the identifiers."""
    name, kind = id_col, encoded.schema[id_col].dataType.simpleString()
    run = by_value(pa.string(), lambda: vocabulary(path).decode, [name, "text"])
    return encoded.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, f"`{name}` {kind}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, `ids` and `decoded`: the identifiers, and the text decoded from those identifiers."""
    name, kind = id_col, docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_one = vocabulary(path).decode
        for batch in encode_batches(batches):
            decoded = [decode_one(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], names=[name, "ids", "decoded"])

    encode_batches = by_value(pa.binary(), lambda: vocabulary(path).encode, [name, "ids"], 4 << 20)
    rows = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"`{name}` {kind}, ids binary, decoded string")
