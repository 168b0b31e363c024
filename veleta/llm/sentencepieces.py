"""SentencePiece encoding that keeps offsets, and decoding.

The text is normalised by the longest prefixes that the model's compiled
character map (a double-array trie over UTF-8) knows; every normalised
character records the byte of the original text that it begins at. Merges run
on the normalised text, and the pieces' ends are projected back through that
record, so that every piece has its span of original bytes.

No piece of such a vocabulary has a word mark behind another character, so the
normalised text is cut before each run of marks and the cuts are encoded
independently: all distinct ones of a batch of texts together, round by round.
A model whose pieces cross such cuts is encoded uncut.

Identifiers and ends are little-endian unsigned 32-bit integers in binary
columns; piece i covers the bytes from end i-1 to end i (white space that a
model drops at the start is before the begin identifier's end). A character
outside the vocabulary becomes byte pieces, of which the last one has its span.
Defined results: null text encodes as an empty text, to the begin and end
identifiers alone, and decodes to an empty text; repeated rows and tied
identifiers are encoded row by row; an empty table gives an empty result; very
long texts and words take n log n steps; further columns of the input are
dropped, whatever their names. Models of another kind than byte-pair merges
with byte fallback, or with symbols of the user's own, are refused.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.llm.shared import small_batches

#: The word mark, the text of an unknown piece, kinds of pieces and the kind of model in the file format.
MARK = "▁"
MARK_BYTES = MARK.encode()
UNKNOWN_TEXT = " ⁇ "
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BYTE_PAIRS = 2
#: Cuts longer than this are merged on their own, with a heap.
SHORT = 48
#: More than any rank.
NONE = 1 << 30
#: Characters whose new cuts are merged together, and bytes of results that are handed back at a time.
MOST_CHARS = MOST_BYTES = 4 << 20


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, message[at : at + size]
        at += size


class CharacterMap:
    """The compiled map of a model: a trie over UTF-8 bytes, and the texts that its leaves stand for."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units, self.texts = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist(), compiled[4 + size :]
        self.values: dict[int, str] = {}

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, str]:
        """Bytes of the longest known prefix of text[at:], 0 where there is none, and what it becomes."""
        units, node, size, value = self.units, self._offset(self.units[0]), 0, -1
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                size, value = i + 1 - at, units[node] & 0x7FFFFFFF
        if not size:
            return 0, ""
        if value not in self.values:
            self.values[value] = self.texts[value : self.texts.index(b"\0", value)].decode()
        return size, self.values[value]


def _one_a_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one-a-byte", _one_a_byte)


def widths(text: str) -> np.ndarray:
    """UTF-8 bytes of each character."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)


class Model:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(_fields(f.read()))
        trainer = dict(x for n, part in parts if n == 2 for x in _fields(part))
        rules = dict(x for n, part in parts if n == 3 for x in _fields(part))
        pieces = [dict(_fields(part)) for n, part in parts if n == 1]
        kinds = [p.get(3, NORMAL) for p in pieces]
        if trainer.get(3, 1) != BYTE_PAIRS or not trainer.get(35, 0) or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only models of byte-pair merges with byte fallback and without symbols of the user's own are known")
        if rules.get(5, 1) != 1 or trainer.get(24, 0) or any(n == 5 for n, _ in parts):
            raise ValueError("marks that are not escaped or stand behind words, and rules for decoding, are not known")
        self.prefix, self.squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        self.map = CharacterMap(rules[2]) if rules.get(2) else None
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        texts = [p.get(1, b"").decode() for p in pieces]
        scores = [float(np.frombuffer(p[2], "<f4")[0]) if 2 in p else 0.0 for p in pieces]
        self.ids = {t: i for i, (t, k) in enumerate(zip(texts, kinds)) if k == NORMAL}
        byte_id = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(texts, kinds)) if k == BYTE}
        self.byte_id = [byte_id[b] for b in range(256)]
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        #: rank of each piece that a merge can make
        self.rank = {t: order[scores[i]] for t, i in self.ids.items() if len(t) > 1}
        surfaces = {NORMAL: lambda t: t.replace(MARK, " "), UNKNOWN: lambda t: UNKNOWN_TEXT, CONTROL: lambda t: ""}
        self.surface = [bytes([int(t[3:5], 16)]) if k == BYTE else surfaces[k](t).encode() for t, k in zip(texts, kinds)]
        self.marked = [k == NORMAL and t.startswith(MARK) for t, k in zip(texts, kinds)]
        #: symbol of each character that is a piece, -1 for others
        self.symbol_of = np.full(0x110000, -1, np.int64)
        for t, i in self.ids.items():
            if len(t) == 1:
                self.symbol_of[ord(t)] = i
        pairs = {}
        for t, i in self.ids.items():
            for cut in range(1, len(t)):
                if t[:cut] in self.ids and t[cut:] in self.ids:
                    pairs[self.ids[t[:cut]] << 32 | self.ids[t[cut:]]] = self.rank[t], i
        #: pairs that make a piece (left << 32 | right, sorted), the rank of that piece and the piece; a last one that is never met
        self.pairs = np.array([*sorted(pairs), 1 << 62], np.int64)
        self.pair_rank, self.pair_made = np.array([pairs.get(p, (NONE, 0)) for p in self.pairs.tolist()], np.int64).T.copy()
        self.crossing = any(MARK in t.lstrip(MARK) for t in self.ids)

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters, and its end, the byte of the original that it begins at."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self.map is None and not self.squeeze:
            lead = [0] * self.prefix
            return MARK * self.prefix + text.replace(" ", MARK), np.concatenate([lead, [0], np.cumsum(widths(text))]).astype(np.int64)
        found, back, at, data = [], [], 0, text.encode()
        after_space = self.squeeze
        for unit, size in self._units(data):
            while after_space and unit.startswith(" "):
                unit = unit[1:]
            if unit:
                if not back and self.prefix:
                    found.append(MARK)
                    back.append(at)
                found.append(unit.replace(" ", MARK))
                back.extend([at] * len(unit))
                after_space = unit.endswith(" ")
            at += size
            after_space = after_space and self.squeeze
        if not back and self.prefix and not self.squeeze:
            found.append(MARK)
            back.append(0)
        out = "".join(found)
        if self.squeeze:
            while out.endswith(MARK):
                out, at = out[:-1], back.pop()
        return out, np.array([*back, at], np.int64)

    def _units(self, data: bytes) -> Iterator[tuple[str, int]]:
        """What the text is made of, from the left: longest known prefixes as their texts, else characters; with their bytes."""
        at = 0
        while at < len(data):
            size, value = self.map.longest(data, at) if self.map is not None else (0, "")
            if not size:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                value = data[at : at + size].decode()
            yield value, size
            at += size

    def _encode_cut(self, cut: str) -> tuple[list[int], list[int]]:
        """Identifiers of a cut, and how many of its characters each of them covers."""
        ids, covers = [], []
        for part in self._merge(cut):
            if part in self.ids:
                ids.append(self.ids[part])
                covers.append(len(part))
            else:
                ids.extend(map(self.byte_id.__getitem__, part.encode()))
                covers.extend([*bytes(len(part.encode()) - 1), 1])
        return ids, covers

    def _encode_cuts(self, cuts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for many cuts: identifiers, characters covered, and how many identifiers each cut has.

        In each round every cut merges the leftmost of its best pairs, all cuts
        at once; those that are long or hold strange characters go one by one.
        """
        sizes = pc.utf8_length(cuts).to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(cuts)), sizes)
        symbols = self.symbol_of[np.frombuffer("".join(cuts.to_pylist()).encode("utf-32-le"), "<u4")]
        apart = sizes > SHORT
        apart[owner[symbols < 0]] = True
        together = ~apart[owner]
        owner, symbols = owner[together], symbols[together]
        covers, done = np.ones(len(symbols), np.int64), []
        rank, made = self._pairs_at(np.arange(len(symbols)), symbols, owner)
        while len(symbols):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), first)
            goes_on = best >> 32 != NONE
            each = np.repeat(goes_on, np.diff(first, append=len(symbols)))
            at = best[goes_on] & 0xFFFFFFFF
            symbols[at] = made[at]
            covers[at] += covers[at + 1]
            done.append((owner[~each], symbols[~each], covers[~each]))
            each[at + 1] = False
            at = np.cumsum(each)[at] - 1
            owner, symbols, covers, rank, made = owner[each], symbols[each], covers[each], rank[each], made[each]
            for i in (at, at[at > 0] - 1):
                rank[i], made[i] = self._pairs_at(i, symbols, owner)
        for i in np.flatnonzero(apart).tolist():
            ids, spans = self._encode_cut(cuts[i].as_py())
            done.append((np.full(len(ids), i), np.array(ids, np.int64), np.array(spans, np.int64)))
        owner, symbols, covers = map(np.concatenate, zip(*done))
        order = np.argsort(owner, kind="stable")
        return symbols[order], covers[order], np.bincount(owner, minlength=len(cuts))

    def _pairs_at(self, at: np.ndarray, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the pairs that begin at the given places, NONE where they make none."""
        right = np.minimum(at + 1, len(symbols) - 1)
        key = symbols[at] << 32 | symbols[right]
        found = np.searchsorted(self.pairs, key)
        fits = (self.pairs[found] == key) & (owner[at] == owner[right]) & (right > at)
        return np.where(fits, self.pair_rank[found], NONE), self.pair_made[found]

    def _merge(self, cut: str) -> list[str]:
        """Merge the leftmost pair of the lowest rank until no pair has one: a heap of pairs over a linked list."""
        rank, parts, n = self.rank.get, list(cut), len(cut)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(cut, cut[1:])) if (r := rank(a + b, NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i] = new = a + b
            parts[j] = ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(new + parts[k], NONE)) != NONE:
                    heapq.heappush(heap, (r, i, new, parts[k]))
            if (h := before[i]) >= 0 and (r := rank(parts[h] + new, NONE)) != NONE:
                heapq.heappush(heap, (r, h, parts[h], new))
        return list(filter(None, parts))

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Of each text the identifiers, begin and end included, and the original byte at which each piece ends."""
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and size < MOST_CHARS:
                size += len(texts[stop])
                stop += 1
            yield from self._encode_some(texts[start:stop])
            start = stop

    def _encode_some(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Cuts of all texts, each distinct one encoded once, put together again and projected back."""
        normal, backs = zip(*map(self.normalise, texts))
        data = [n.encode() for n in normal]
        text_starts = np.cumsum([0, *map(len, data)])
        joined = b"".join(data)
        starts = self._cut(np.frombuffer(joined, np.uint8), text_starts)
        offsets = np.append(starts, len(joined)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined)).dictionary_encode()
        which = words.indices.to_numpy().astype(np.int64)
        ids, covers, counts = self._encode_cuts(words.dictionary) if len(which) else (np.zeros(0, np.int64),) * 3
        # pieces of every word, from the pieces of the distinct ones
        each = counts[which]
        piece = np.repeat((np.cumsum(counts) - counts)[which] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        text_of = np.repeat(np.searchsorted(text_starts, starts, "right") - 1, each)
        back = np.concatenate(backs)
        ends = back[np.cumsum(covers[piece]) + text_of]  # a text's record has one more entry than characters
        bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
        out_ids, out_ends = ids[piece].astype("<u4"), ends.astype("<u4")
        for b, start, end in zip(backs, bounds.tolist(), bounds[1:].tolist()):
            yield (
                np.concatenate([[self.begin], out_ids[start:end], [self.end]]).astype("<u4").tobytes(),
                np.concatenate([b[:1], out_ends[start:end], b[-1:]]).astype("<u4").tobytes(),
            )

    def _cut(self, data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        """Where cuts begin in the bytes of joined texts: at each text, and at each mark that does not follow one."""
        begins = np.zeros(len(data) + 1, bool)
        if not self.crossing and len(data) >= len(MARK_BYTES):
            mark = data[:-2] == MARK_BYTES[0]
            mark = np.append(mark & (data[1:-1] == MARK_BYTES[1]) & (data[2:] == MARK_BYTES[2]), [False, False])
            begins[:-1] = mark
            begins[3:-1] &= ~mark[:-3]
        begins[text_starts] = True
        return np.flatnonzero(begins[:-1])

    def decode(self, ids: bytes) -> str:
        """The text of identifiers; bytes that make no character become U+FFFD, one each."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        texts = list(map(self.surface.__getitem__, numbers))
        if self.prefix or self.squeeze:
            for i, n in enumerate(numbers):  # the mark before the first word is no space
                if self.marked[n]:
                    texts[i] = texts[i][1:]
                if texts[i] or self.marked[n] and not self.squeeze:
                    break
        return b"".join(texts).decode("utf-8", "one-a-byte")


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """The model of this worker; read once."""
    return Model(path)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("text")), docs.schema[id_col].dataType.simpleString()


def _in_parts(batch: pa.RecordBatch, rows: Iterable[tuple[int, tuple]], kinds: tuple[pa.DataType, ...], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of bounded bytes out of (bytes, values) of each row of `batch`, its first column before them."""
    held, size, start = [], 0, 0
    for i, (n, values) in enumerate(rows):
        held.append(values)
        size += n
        if size > MOST_BYTES or i + 1 == batch.num_rows:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*held), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(held)), *columns], names=names)
            held, size, start = [], 0, i + 1


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, `ids` and `ends`: identifiers of the whole text and the original bytes that the pieces end at."""
    rows, kind = _texts(docs, id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            each = m.encode(batch.column(1).to_pylist())
            yield from _in_parts(batch, ((2 * len(e[0]), e) for e in each), (pa.binary(), pa.binary()), [id_col, "ids", "ends"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids binary, ends binary")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col and `text`, decoded from the identifiers."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            each = (m.decode(x.as_py() or b"") for x in batch.column(1))
            yield from _in_parts(batch, ((len(t), (t,)) for t in each), (pa.string(),), [id_col, "text"])

    return encoded.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, `ids`, `ends` and `decoded`: the text decoded from those identifiers."""
    rows, kind = _texts(docs, id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            each = ((*e, m.decode(e[0])) for e in m.encode(batch.column(1).to_pylist()))
            kinds = (pa.binary(), pa.binary(), pa.string())
            yield from _in_parts(batch, ((3 * len(e[0]), e) for e in each), kinds, [id_col, "ids", "ends", "decoded"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids binary, ends binary, decoded string")
