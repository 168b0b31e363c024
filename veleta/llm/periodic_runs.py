"""Periodic runs of words: Lyndon roots by suffix grouping, extended to runs.

The first phase of a grouping suffix sorter puts suffixes into groups by their
longest Lyndon prefixes, greatest group first; the length of a suffix's group
at the end is its entry in the Lyndon array, so that the array comes out of the
sorter directly. It is run under the order of the words and under the opposite
one: every run has a root that is a longest Lyndon word under one of them. Each
root that is followed by its like is extended to both sides as far as words one
period apart are equal (longest common extensions); what is long enough is a run.

Only stretches of a text in which every word lies in a repeated window of
`WINDOW` words can hold a run of `LEAST` words and `TIMES` periods: such a run's
windows all occur again one period on. Stretches are found by window hashes,
whose collisions can but add to them; grouping and extension work on the words
themselves, so no result rests on a hash.

Defined results: a null, empty or blank text has no words and no run, and an
empty collapsed text; identifiers that are tied, repeated rows and rows without
an identifier are treated row by row; very long texts take linear steps but for
sorting; an empty table gives an empty result; further columns of the input are
dropped, whatever their names. There is no shuffle: a text is worked on where
it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.llm.shared import small_batches
from veleta.llm.text import byte_texts

#: A run has at least so many words and so many periods.
LEAST, TIMES = 24, 3
#: Words of a window; LEAST words of TIMES periods repeat two thirds of themselves.
WINDOW = LEAST * (TIMES - 1) // TIMES
#: Words at first compared of an extension; twice as many each time.
STEP = 64
Run = tuple[int, int, int]


def lyndon_array(codes: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place, by the first phase of the grouping sorter.

    Groups are intervals of `order`, named by their first place in it; a greater
    name is a greater group. The greatest group not yet seen is final: each of
    its suffixes is appended to the nearest suffix before it of a smaller group,
    and suffixes that got equally many move to a new group right after their own.
    """
    n = len(codes)
    order_ = np.argsort(codes, kind="stable")
    ranked = codes[order_]
    firsts = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    names = np.maximum.accumulate(np.where(firsts, np.arange(n), 0))
    group_ = np.empty(n, np.int64)
    group_[order_] = names
    place_ = np.empty(n, np.int64)
    place_[order_] = np.arange(n)
    order, group, place = order_.tolist(), group_.tolist(), place_.tolist()
    size, length = np.bincount(names, minlength=n).tolist(), [1] * n
    before = [-1] * n
    end = n
    while end:
        name = group[order[end - 1]]
        grown = length[name]
        found: dict[int, int] = {}
        for i in sorted(order[name:end]) if end - name > 1 else order[name:end]:
            p = i - 1
            while p >= 0 and group[p] >= name:
                p = before[p]
            before[i] = p
            if p >= 0:
                found[p] = found.get(p, 0) + 1
        by: dict[tuple[int, int], list[int]] = {}
        for p, times in found.items():
            by.setdefault((-times, group[p]), []).append(p)
        for times, old in sorted(by) if len(by) > 1 else by:
            members = by[times, old]
            new = old + size[old] - len(members)
            if new != old:
                size[old] -= len(members)
                size[new] = len(members)
                for at, p in enumerate(members, new):
                    here, other = place[p], order[at]
                    order[here], order[at] = other, p
                    place[other], place[p] = here, at
                    group[p] = new
            length[new] = length[old] - times * grown
        end = name
    return np.array(length, np.int64)[np.array(group, np.int64)]


def extension(codes: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and from j on (step 1), or before them (step -1), are equal; i < j."""
    room, done, size = (len(codes) - j if step > 0 else i), 0, STEP
    while done < room:
        size = min(size, room - done)
        a, b = ((x + done, x + done + size) if step > 0 else (x - done - size, x - done) for x in (i, j))
        differ = np.flatnonzero(codes[slice(*a)][::step] != codes[slice(*b)][::step])
        if len(differ):
            return done + int(differ[0])
        done, size = done + size, 2 * size
    return done


def runs_of(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """Start, length and period of every run of at least `least` words and `times` periods, 3 or more.

    In such a run a root starts in the first period and has its like right
    after it, whole.
    """
    n, found = len(codes), set()
    for sign in (1, -1):
        period = lyndon_array(sign * codes)
        at = np.arange(n)
        fits = at + 2 * period <= n
        at, period = at[fits], period[fits]
        same = (codes[at] == codes[at + period]) & (codes[at + period - 1] == codes[at + 2 * period - 1])
        at, period = at[same], period[same]
        order, last, until = np.lexsort((at, period)), 0, 0
        for i, p in zip(at[order].tolist(), period[order].tolist()):
            if p == last and i + p <= until:  # within what an earlier root of this period was extended to
                continue
            right, left = extension(codes, i, i + p, 1), extension(codes, i, i + p, -1)
            last, until = p, i + p + right
            if left + right + p >= max(least, times * p):
                found.add((i - left, left + right + p, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


_MIX = np.uint64(0x9E3779B97F4A7C15)  # a fixed odd number, as any other would do


def stretches(codes: np.ndarray, window: int = WINDOW, least: int = LEAST) -> list[tuple[int, int]]:
    """Maximal stretches, `least` words long or more, of words that lie in repeated windows."""
    n = len(codes)
    if n < least:
        return []
    with np.errstate(over="ignore"):
        h = codes.astype(np.uint64)
        h = (h + np.uint64(1)) * _MIX
        h ^= h >> np.uint64(29)
        size = 1
        while size < window:  # hashes of twice as many words, of `window` words in the end
            step = min(size, window - size)
            h = h[: len(h) - step] * _MIX + (h[step:] ^ (h[step:] >> np.uint64(31)))
            size += step
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(h, twice))
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    covered = np.concatenate([[0], (np.cumsum(edge[:n]) > 0).astype(np.int8), [0]])
    turns = np.flatnonzero(np.diff(covered))
    return [(a, b) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()) if b - a >= least]


def find_runs(codes: np.ndarray) -> list[Run]:
    """All runs of a text's words, by start and period."""
    found = []
    for a, b in stretches(codes):
        dense = np.unique(codes[a:b], return_inverse=True)[1].astype(np.int64)
        found += [(a + start, length, period) for start, length, period in runs_of(dense)]
    return found


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those that no run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def collapse(words: list[bytes], codes: np.ndarray | None = None) -> tuple[list[Run], bytes]:
    """Runs of the words, and the text of those that stay, joined by one space."""
    if len(words) < LEAST:
        return [], b" ".join(words)
    if codes is None:
        codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy()
    runs = find_runs(codes)
    if not runs:
        return [], b" ".join(words)
    stays = kept_words(len(words), runs)
    return runs, b" ".join([w for w, s in zip(words, stays.tolist()) if s])


def make_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, of a tenth of the identifiers with a periodic end; without an identifier as they are."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def detect(
    docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id_col, `n_words`, `runs` (start, length, period; by start and period) and `collapsed`, the text without what runs repeat.

    `change` makes the words to look at out of the identifier and the words of the text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)
    made = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), byte_texts([batch], 1)
            held, size, start = [], 0, 0
            for i, text in enumerate(texts):
                words = text.split()
                if change is not None:
                    words = change(ids[i].as_py(), words)
                runs, left = collapse(words)
                held.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], left.decode()))
                size += len(left)
                if size > 8 << 20 or i + 1 == batch.num_rows:
                    n, r, c = zip(*held)
                    columns = [ids.slice(start, len(held)), pa.array(n, pa.int64()), pa.array(r, made), pa.array(c, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "runs", "collapsed"])
                    held, size, start = [], 0, i + 1

    schema = f"`{id_col}` {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of each row the number of runs, the one of the greatest length by period, and digests of runs and text.

    Exponents are compared as fractions: a/b > c/d where a*d > c*b.
    """
    times = lambda x, y: x["length"].cast("decimal(19,0)") * y["period"].cast("decimal(19,0)")
    # the runs come by start and period, so that the first of equal ones is the one to take
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda top, r: F.when(times(r, top) > times(top, r), r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("best_", best).select(
        F.col(id_col),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best_.start").alias("start"),
        F.col("best_.length").alias("length"),
        F.col("best_.period").alias("period"),
        F.floor(F.col("best_.length") * 1000 / F.col("best_.period")).cast("long").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
