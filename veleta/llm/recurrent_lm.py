"""Language-model scoring with a gated recurrent network in numpy.

The network reads one word at a time (one update gate, H units) and predicts
the next one by a class-factored softmax: first its class, then the word in
the class. The most frequent training words are in the classes. All others are
in the tail class, and each has a slot by its hash. There are about as many
slots as training words seen `SEEN_OFTEN` times (`MOST_DIGITS` ** `DIGITS` at
most, which bounds what is sent to the tasks). A slot is predicted digit by
digit, each from the state and from the masses of the digits before, and read
as the sum of a row and a column vector; so the network's parameters grow with
the square root of the slots only. Words that meet in a slot are told apart by
their smoothed frequency, so that every text has a probability.

Training is truncated backpropagation through time over windows of `WINDOW`
steps; the state is carried from window to window, in training through
segments of `SEGMENT` tokens (so that one long document does not leave the
other lanes idle), in scoring until the document ends, however long it is. A
score is the log-likelihood of the complete document.

1. Words of all training documents are counted (combined per partition, then
   shuffled by word).
2. A start is trained on about `START_DOCS` documents, picked by hash. Then, in
   each of `ROUNDS` rounds, every partition trains on the next share of its
   training documents, and the parameters are averaged, weighted by tokens, in a
   tree of which each node takes about `FAN_IN` of them; one small row reaches
   the driver, and the next round starts from it. So the model, and with it the
   scores, depend on how the table is partitioned; base scores do not.
3. Every document is scored where it lies. The most frequent words
   (`KNOWN_WORDS`, a bounded list) and the slots' masses are sent to the tasks;
   counts of the rest are joined by word.

Defined results: null text is an empty text, whose only token is its end;
repeated rows and tied identifiers are scored row by row; a null identifier is
in the training part; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm.shared import forget, keep, small_batches
from veleta.llm.text import byte_words, parts, string_array, word_codes

#: The end of a document as a token; no word holds a line feed.
END = "\n"
UNITS = 24
CLASS_WORDS = 48
CLASSES = 48
WINDOW = 32
#: Steps that are scored at a time; the result is the same for any number.
SCORE_WINDOW = 64
#: Tokens of training text through which a state is carried at most.
SEGMENT = 2048
#: Documents that are read side by side, for the start and then for everything.
START_LANES = 64
LANES = 256
RATE = 0.02
#: Steps over which the rate rises, in every task.
WARM_STEPS = 50
#: Output biases begin at the training frequencies and move slowly.
BIAS_PACE = 0.05
#: Bound of an output weight. States lie within 1, so that no exponential of a sum of UNITS products overflows.
LIMIT = 2.5
#: The tail has about as many slots as words seen so often; a slot has so many digits (an even number), each below the bound.
SEEN_OFTEN = 5
DIGITS = 4
MOST_DIGITS = 32
#: Shares of the training documents, each trained on from the average over the ones before.
ROUNDS = 3
#: Documents of the start, a bounded sample.
START_DOCS = 1024
#: Parameter rows that one task averages.
FAN_IN = 8
#: Most frequent words that are sent to the tasks.
KNOWN_WORDS = 1 << 18
#: Tokens that are held at a time for training or scoring.
CHUNK_TOKENS = 2_000_000


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are kept out of training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def tokens(text: str | bytes) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased."""
    return byte_words(text.encode() if isinstance(text, str) else text)


def count_words(docs: DataFrame, most: int = 400_000) -> DataFrame:
    """word, n over all texts of `docs` (column text); the end counts once a document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([string_array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in parts(batch, 0):
                words, codes, _ = word_codes(part.column(0))
                counts.update(dict(zip(words, np.bincount(codes, minlength=len(words)).tolist())))
                counts[END.encode()] += part.num_rows
                if len(counts) > most:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _add_rows(total: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """total[ids] += rows, where identifiers (below 2^15) repeat."""
    if len(ids):
        order = np.argsort(ids.astype(np.int16), kind="stable")
        ids = ids[order]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        total[ids[starts]] += np.add.reduceat(rows[order], starts)


class Model:
    """Parameters; words 0 .. k - 1 are in classes of CLASS_WORDS, word k + i stands for slot i of the tail.

    `parts` are views of the one vector `flat`. `levels[j]` holds the log
    probabilities of digit j given the digits before, without a state; they are
    not trained.
    """

    def __init__(self, k: int, base: int, levels: list[np.ndarray], shapes: dict[str, tuple[int, ...]], flat: np.ndarray):
        self.k, self.base, self.levels, self.shapes, self.flat = k, base, levels, shapes, flat
        self.parts = self.views(flat)

    def __reduce__(self):
        return Model, (self.k, self.base, self.levels, self.shapes, self.flat)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        found, at = {}, 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            found[name] = flat[at : at + size].reshape(shape)
            at += size
        return found

    def filled(self, flat: np.ndarray) -> Model:
        return Model(self.k, self.base, self.levels, self.shapes, flat.astype(np.float32))

    @staticmethod
    def new(counts: np.ndarray, tail: float, seed: int = 1, slots: np.ndarray | None = None) -> Model:
        """Small random weights; biases give the training frequencies. `slots` has base ** DIGITS masses."""
        rng, k, s, h = np.random.default_rng(seed), len(counts), CLASS_WORDS, UNITS
        classes = -(-k // s)
        padded = np.concatenate([counts.astype(float), np.full(classes * s - k, 1e-30)]).reshape(classes, s)
        mass = np.append(padded.sum(1), max(tail, 0.5))
        slots = np.ones(1) if slots is None else slots
        base = round(len(slots) ** (1 / DIGITS))
        side = base ** (DIGITS // 2)
        shapes = {
            "x": (k + 1, 2 * h), "xr": (side, 2 * h), "xc": (side, 2 * h), "u": (h, 2 * h), "b": (2 * h,),
            "cw": (h, classes + 1), "ww": (classes, h, s), "tw": (h, DIGITS * base), "cb": (classes + 1,), "wb": (classes, s),
        }
        levels = []
        for j in range(DIGITS):
            m = slots.reshape(base ** (j + 1), -1).sum(1).reshape(-1, base)
            levels.append(np.log(m / m.sum(1, keepdims=True)).astype(np.float32))
        model = Model(k, base, levels, shapes, np.zeros(sum(int(np.prod(x)) for x in shapes.values()), np.float32))
        p = model.parts
        for name in ("x", "xr", "xc", "u", "cw", "ww", "tw"):
            p[name][:] = rng.standard_normal(shapes[name]) * 0.1
        p["b"][:h] = 0.5  # an open gate half-way
        p["cb"][:] = np.log(mass / mass.sum())
        p["wb"][:] = np.maximum(np.log(padded / padded.sum(1, keepdims=True)), -60.0)
        return model

    def steps(self, state: np.ndarray, seen: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, ...]:
        """States before and after each step, gates and candidates."""
        p, (t, lanes), h = self.parts, seen.shape, UNITS
        before, after = np.empty((t, lanes, h), np.float32), np.empty((t, lanes, h), np.float32)
        gate, new = np.empty_like(before), np.empty_like(before)
        given = p["x"][np.minimum(seen, self.k)]
        given += p["b"]
        if self.base > 1:
            tail = seen >= self.k
            row, column = np.divmod(seen[tail] - self.k, len(p["xc"]))
            given[tail] += p["xr"][row] + p["xc"][column]
        begins, u = fresh.any(1).tolist(), p["u"]
        for i in range(t):
            old, z, g = before[i], gate[i], new[i]
            old[:] = state
            if begins[i]:
                old[fresh[i]] = 0
            a = given[i]
            a += old @ u
            # a piecewise linear gate and a softsign candidate: no exponentials
            np.maximum(a[:, :h], 0, out=z)
            np.minimum(z, 1, out=z)
            np.abs(a[:, h:], out=g)
            g += 1
            np.divide(a[:, h:], g, out=g)
            state = after[i]
            np.subtract(g, old, out=state)
            state *= z
            state += old
        return before, after, gate, new

    def log_probs(self, states: np.ndarray, target: np.ndarray, grads: dict | None = None, live: np.ndarray | None = None):
        """Natural log probabilities of the targets; with `grads`, also the gradient at the states."""
        p, s, k, h, classes = self.parts, CLASS_WORDS, self.k, UNITS, len(self.parts["ww"])
        cls = np.where(target >= k, classes, target // s).astype(np.int16)
        order = np.argsort(cls, kind="stable")
        cls, target = cls[order], target[order]
        # a last state of 1 takes the biases along in every product, and sums of rows are products too
        st = np.empty((len(target), h + 1), states.dtype)
        np.take(states, order, 0, out=st[:, :h])
        st[:, h] = 1
        rows, found = np.arange(len(target)), np.searchsorted(cls, np.arange(classes + 1)).tolist()
        weights = np.vstack([p["cw"], p["cb"]])
        e = st @ weights
        np.exp(e, out=e)
        total, at = e @ np.ones(classes + 1, e.dtype), rows * (classes + 1) + cls
        out = np.log(e.ravel()[at]) - np.log(total)
        back = None
        if grads is not None:
            live = live[order].astype(states.dtype)
            e *= (live / total)[:, None]
            e.ravel()[at] -= live
            g = st.T @ e
            grads["cw"] += g[:h]
            grads["cb"] += g[h]
            back = e @ p["cw"].T
        m = found[-1]  # those in classes come first
        e = np.empty((m, s), st.dtype)
        parts = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(found, found[1:])) if a < b]
        weights = np.concatenate([p["ww"], p["wb"][:, None]], 1)
        for c, at in parts:
            np.matmul(st[at], weights[c], out=e[at])
        np.exp(e, out=e)
        total, at = e @ np.ones(s, e.dtype), rows[:m] * s + target[:m] % s
        out[:m] += np.log(e.ravel()[at]) - np.log(total)
        if grads is not None:
            e *= (live[:m] / total)[:, None]
            e.ravel()[at] -= live[:m]
            g, u = np.zeros_like(weights), np.ascontiguousarray(p["ww"].transpose(0, 2, 1))
            for c, at in parts:
                np.matmul(st[at].T, e[at], out=g[c])
                back[at] += e[at] @ u[c]
            grads["ww"] += g[:, :h]
            grads["wb"] += g[:, h]
        if self.base > 1 and m < len(target):
            out[m:] += self._slot_log_probs(st[m:, :h], target[m:] - k, grads, None if grads is None else live[m:], None if grads is None else back[m:])
        by_row = np.empty_like(out)
        by_row[order] = out
        if grads is None:
            return by_row
        at_states = np.empty_like(back)
        at_states[order] = back
        return by_row, at_states

    def _slot_log_probs(self, states, slot, grads, live, back) -> np.ndarray:
        """The same for slots, given the tail; adds to `grads` and `back` where there are any."""
        p, base, n = self.parts, self.base, len(slot)
        e = states @ p["tw"]
        by_digit = e.reshape(n, DIGITS, base)
        places = [slot // base ** (DIGITS - 1 - j) for j in range(DIGITS)]
        for j in range(DIGITS):
            by_digit[:, j] += self.levels[j][places[j] // base]
        np.exp(e, out=e)
        total = (e.reshape(-1, base) @ np.ones(base, e.dtype)).reshape(n, DIGITS)
        picked = np.stack([x % base + j * base for j, x in enumerate(places)], 1) + np.arange(n)[:, None] * (DIGITS * base)
        flat = e.reshape(-1)
        out = (np.log(flat[picked]) - np.log(total)).sum(1)
        if grads is not None:
            by_digit *= (live[:, None] / total)[:, :, None]
            flat[picked] -= live[:, None]
            grads["tw"] += states.T @ e
            back += e @ p["tw"].T
        return out

    def gradient(self, state: np.ndarray, seen: np.ndarray, target: np.ndarray, fresh: np.ndarray, live: np.ndarray, grads: dict | None = None):
        """Gradient of the summed loss over one window, added to `grads`, and the state after it."""
        p, (t, lanes), h = self.parts, seen.shape, UNITS
        grads = {n: np.zeros_like(v) for n, v in p.items()} if grads is None else grads
        before, after, gate, new = self.steps(state, seen, fresh)
        _, back = self.log_probs(after.reshape(-1, h), target.ravel(), grads, live.ravel())
        back, begins = back.reshape(t, lanes, h), fresh.any(1).tolist()
        to_gate = new - before
        to_gate *= (gate > 0) & (gate < 1)
        to_new = 1 - np.abs(new)
        to_new *= to_new
        to_new *= gate
        carried = 1 - gate
        back_u = np.ascontiguousarray(p["u"].T)
        pre, ahead = np.empty((t, lanes, 2 * h), np.float32), np.zeros((lanes, h), np.float32)
        for i in range(t - 1, -1, -1):
            d, row = back[i], pre[i]
            d += ahead
            np.multiply(d, to_gate[i], out=row[:, :h])
            np.multiply(d, to_new[i], out=row[:, h:])
            d *= carried[i]
            ahead = row @ back_u
            ahead += d
            if begins[i]:
                ahead[fresh[i]] = 0
        rows, ids = pre.reshape(-1, 2 * h), seen.ravel()
        grads["u"] += before.reshape(-1, h).T @ rows
        grads["b"] += rows.sum(0)
        _add_rows(grads["x"], np.minimum(ids, self.k), rows)
        if self.base > 1:
            tail = np.flatnonzero(ids >= self.k)
            row, column = np.divmod(ids[tail] - self.k, len(p["xc"]))
            rows = rows[tail]
            _add_rows(grads["xr"], row, rows)
            _add_rows(grads["xc"], column, rows)
        return grads, after[-1]


class Lanes:
    """Documents laid end to end in lanes, the fullest lane first; windows are cut from them as they are needed.

    `firsts` are the inputs of the documents' first steps, the end by default;
    every other input is the token before.
    """

    def __init__(self, docs: list[np.ndarray], lanes: int, firsts: list[int] | None = None):
        sizes = [len(d) for d in docs]
        members: list[list[int]] = [[] for _ in range(max(1, min(lanes, len(docs))))]
        heap = [(0, lane) for lane in range(len(members))]
        for i in sorted(range(len(docs)), key=lambda i: -sizes[i]):  # longest first, to the emptiest lane
            n, lane = heap[0]
            members[lane].append(i)
            heapq.heapreplace(heap, (n + sizes[i], lane))
        load = [sum(sizes[i] for i in m) for m in members]
        by_load = sorted(range(len(members)), key=lambda lane: -load[lane])
        self.docs = np.array([i for lane in by_load for i in members[lane]], np.int64)
        self.load = np.array([load[lane] for lane in by_load], np.int64)
        self.offset = np.cumsum(self.load) - self.load
        self.flat = np.concatenate([docs[i] for i in self.docs]) if docs else np.empty(0, np.int32)
        size = np.array(sizes, np.int64)[self.docs]
        #: Where each document of `docs` begins in `flat`.
        self.begin = np.cumsum(size) - size
        lane = np.repeat(np.arange(len(by_load)), [len(members[x]) for x in by_load])
        at = self.begin - self.offset[lane]
        order = np.argsort(at, kind="stable")
        first = np.zeros(len(docs), np.int32) if firsts is None else np.array(firsts, np.int32)[self.docs]
        self.starts = at[order], lane[order], first[order]

    def windows(self, width: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Inputs, targets, document starts, live places, and the targets' places in `flat`, (steps, lanes) each."""
        at, lane, first = self.starts
        for a in range(0, int(self.load[0]), width):
            t, n = min(width, int(self.load[0]) - a), int((self.load > a).sum())
            step = np.arange(a, a + t)[:, None]
            live = step < self.load[:n]
            index = np.where(live, self.offset[:n] + step, self.offset[:n])
            target, seen = self.flat[index], self.flat[index - 1]
            fresh = np.zeros((t, n), bool)
            cut = slice(*np.searchsorted(at, (a, a + t)))
            fresh[at[cut] - a, lane[cut]] = True
            seen[at[cut] - a, lane[cut]] = first[cut]
            yield seen, target, fresh, live, index


def segments(docs: list[np.ndarray], most: int = SEGMENT) -> tuple[list[np.ndarray], list[int]]:
    """Documents in segments of at most `most` tokens, and the token before each of them."""
    found, firsts = [], []
    for d in docs:
        for a in range(0, len(d), most):
            found.append(d[a : a + most])
            firsts.append(int(d[a - 1]) if a else 0)
    return found, firsts


def train(model: Model, chunks: Iterable[list[np.ndarray]], rate: float = RATE, lanes: int = LANES) -> tuple[Model, int]:
    """Truncated backpropagation over all windows of all chunks; steps by Adam. The model is changed in place."""
    flat = model.flat
    m1, m2, grad, move = (np.zeros_like(flat) for _ in range(4))
    own, bound = np.ones_like(flat), np.full_like(flat, np.inf)
    for views, names, value in ((model.views(own), ("cb", "wb"), BIAS_PACE), (model.views(bound), ("cw", "ww", "tw"), LIMIT)):
        for n in names:
            views[n][:] = value
    grads = model.views(grad)
    step = n_tokens = 0
    for docs in chunks:
        if not docs:
            continue
        pieces, firsts = segments(docs)
        laid = Lanes(pieces, lanes, firsts)
        state, full = np.zeros((len(laid.load), UNITS), np.float32), WINDOW * len(laid.load)
        for seen, target, fresh, live, _ in laid.windows(WINDOW):
            grad[:] = 0
            _, state = model.gradient(state[: seen.shape[1]], seen, target, fresh, live, grads)
            step += 1
            n_live = int(live.sum())
            n_tokens += n_live
            grad /= n_live
            # a window of few documents moves little, or the last ones of a chunk would have the last word
            part = min(1.0, step / WARM_STEPS) * n_live / full
            pace = np.float32(part * rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step))
            m1 *= 0.9
            m1 += np.multiply(grad, 0.1, out=move)
            m2 *= 0.999
            grad *= grad
            m2 += np.multiply(grad, 0.001, out=move)
            np.sqrt(m2, out=move)
            move += 1e-4
            np.divide(m1, move, out=move)
            move *= own
            move *= pace
            flat -= move
            np.minimum(flat, bound, out=flat)
            np.maximum(flat, -bound, out=flat)
    return model, n_tokens


def score_docs(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each document; a slot counts as one word."""
    if not docs:
        return np.zeros(0)
    laid = Lanes(docs, LANES)
    state, each = np.zeros((len(laid.load), UNITS), np.float32), np.zeros(len(laid.flat))
    for seen, target, fresh, live, index in laid.windows(SCORE_WINDOW):
        _, after, _, _ = model.steps(state[: seen.shape[1]], seen, fresh)
        state, on = after[-1], live.ravel()
        each[index.ravel()[on]] = model.log_probs(after.reshape(-1, UNITS)[on], target.ravel()[on])
    out = np.zeros(len(docs))
    out[laid.docs] = np.add.reduceat(each, laid.begin)
    return out


@dataclass
class Vocabulary:
    """Training counts: the listed words by rank with the end first, totals, and the tail's mass by slot.

    The mass of a slot is its tokens, and a half for each of its words and for all unseen ones.
    """

    words: list[str]
    counts: np.ndarray
    total: int
    distinct: int
    slots: np.ndarray

    @property
    def k(self) -> int:
        return min(len(self.words), CLASSES * CLASS_WORDS)

    def tail_tokens(self) -> float:
        """Tokens outside the classes."""
        return float(self.total - self.counts[: self.k].sum())


def slot_of(word: str | bytes, n_slots: int) -> int:
    return zlib.crc32(word.encode() if isinstance(word, str) else word) % n_slots


def _vocabulary(counts: DataFrame) -> Vocabulary:
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.max(F.when(F.col("word") == END, F.col("n"))).alias("e"), F.count_if(F.col("n") >= SEEN_OFTEN).alias("often")).first()
    # the least count whose words are few enough, from the table of counts of counts; no partition sends a top list
    sizes = counts.filter(F.col("word") != END).groupBy("n").agg(F.count(F.lit(1)).alias("words")).toPandas().sort_values("n", ascending=False)
    fits = sizes["n"][sizes["words"].cumsum() <= KNOWN_WORDS]
    known = counts.filter((F.col("word") != END) & (F.col("n") >= F.lit(int(fits.min()) if len(fits) else 1 << 62))).toPandas()
    top = known.sort_values(["n", "word"], ascending=[False, True])
    words = [END, *top["word"].tolist()]
    ends = totals.e or 0
    found = Vocabulary(words, np.array([ends, *top["n"].tolist()], np.int64), int(totals.n or 0), int(totals.v or 0) + (totals.e is None), np.ones(1))
    n_slots = min(MOST_DIGITS, max(1, round(max(0, totals.often - found.k) ** (1 / DIGITS)))) ** DIGITS
    slot = (F.crc32(F.col("word").cast("binary")) % n_slots).cast("int").alias("slot")
    by_slot = counts.groupBy(slot).agg((F.sum("n") + F.count(F.lit(1)) / 2).cast("double").alias("mass")).toArrow()
    found.slots = np.full(n_slots, 0.5)
    found.slots[by_slot["slot"].to_numpy()] += by_slot["mass"].to_numpy()
    for i, word in enumerate(words[: found.k]):  # these are in the classes
        if i or totals.e is not None:
            found.slots[slot_of(word, n_slots)] -= found.counts[i] + 0.5
    return found


def _average(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted mean of parameter rows, one at a time."""
    total, weight = None, 0
    for batch in batches:
        for params, n in zip(batch.column(0), batch.column(1)):
            v = np.frombuffer(params.as_buffer(), np.float32) * np.float64(n.as_py())
            total = v if total is None else total + v
            weight += n.as_py()
    if total is not None:
        yield _params_row(total / weight, weight)


def _params_row(flat: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([flat.astype(np.float32).tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["params", "n"])


def _chunks(batches: Iterable[pa.RecordBatch], number) -> Iterator[list[np.ndarray]]:
    """Documents as their words' numbers, the end last, by chunks of bounded tokens."""
    held, size = [], 0
    for batch in batches:
        for part in parts(batch, 0):
            words, codes, bounds = word_codes(part.column(0))
            numbers, bounds = np.fromiter(map(number, words), np.int32, len(words))[codes], bounds.tolist()
            for a, b in zip(bounds, bounds[1:]):
                held.append(np.append(numbers[a:b], np.int32(0)))
                size += len(held[-1])
                if size >= CHUNK_TOKENS:
                    yield held
                    held, size = [], 0
    if held:
        yield held


class _Numbers(dict):
    """The model's numbers of words; any word that is not in a class has that of its slot."""

    def __init__(self, index: dict[bytes, int], k: int, n_slots: int):
        super().__init__(index)
        self.k, self.n_slots = k, n_slots

    def __missing__(self, word: bytes) -> int:
        return self.k + zlib.crc32(word) % self.n_slots


def fit(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary) -> Model:
    """A model trained on all texts of `docs`."""
    k, n_slots = vocabulary.k, len(vocabulary.slots)
    known = spark.sparkContext.broadcast({w.encode(): i for i, w in enumerate(vocabulary.words[:k])})
    begin = Model.new(vocabulary.counts[:k] + 0.5, vocabulary.tail_tokens(), slots=vocabulary.slots)

    def trained(rows: DataFrame, start: Model, rate: float, lanes: int) -> Model:
        shared = spark.sparkContext.broadcast(start)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, start = known.value, shared.value
            number = _Numbers(index, k, n_slots).__getitem__

            model, n = train(start.filled(start.flat), _chunks(batches, number), rate, lanes)
            if n:
                yield _params_row(model.flat, n)

        # one row for each partition that had text; a lost executor costs no second training
        level = made = keep(spark, rows.select("text").mapInArrow(run, "params binary, n long"), "params")
        width = made.count()
        while width > 1:
            width = -(-width // FAN_IN)
            level = level.repartition(width).mapInArrow(_average, "params binary, n long")
        found = level.collect()  # one row at most
        forget(spark, made)
        return start.filled(np.frombuffer(found[0].params, np.float32)) if found else start

    draw = F.xxhash64("text", "doc_id")
    n_docs = max(1, int(vocabulary.counts[0]))
    model = trained(docs.filter(F.pmod(draw, F.lit(n_docs)) < START_DOCS).repartition(1), begin, RATE, START_LANES)
    for i in range(ROUNDS):
        model = trained(docs.filter(F.pmod(draw, F.lit(ROUNDS)) == i), model, RATE / 2, LANES)
    return model


_SCORED = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.string())),
    ]
)
_SCORED_FIELDS = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<string>"


class _Ranks(dict):
    """Ranks of the listed words; any other word has the rank after the last."""

    def __missing__(self, word: bytes) -> int:
        return len(self)


def score(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    small_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("held_out", held_out())
    training = base.filter(~F.col("held_out"))
    counts = keep(spark, count_words(training), "words")
    vocabulary = _vocabulary(counts)
    model = fit(spark, training, vocabulary)
    k, total, distinct = vocabulary.k, vocabulary.total, vocabulary.distinct
    divisor = total + 0.5 * (distinct + 1)
    shared = spark.sparkContext.broadcast((vocabulary.words, vocabulary.counts, vocabulary.slots, model))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n_of, slots, model = shared.value
        rank = _Ranks((w.encode(), i) for i, w in enumerate(words))
        number, n_words, n_slots = rank.__getitem__, len(words), len(slots)
        base_log = np.append(np.log10((n_of + 0.5) / divisor), 0.0)
        in_model = np.array([*range(k), *(k + slot_of(w, n_slots) for w in words[k:]), k], np.int32)
        tail_log = np.log10((n_of + 0.5) / slots[np.maximum(in_model[:-1] - k, 0)])
        tail_log[:k] = 0.0
        tail_log, is_known, slot_log = np.append(tail_log, 0.0), np.append(n_of > 0, False), np.log10(slots)

        def encoded(texts: pa.Array) -> Iterator[tuple]:
            """The model's numbers, and tokens, known ones, base score, what the tail's counts add, and the words without a rank, of each text."""
            words, codes, bounds = word_codes(texts)
            ranks, bounds = np.fromiter(map(number, words), np.int32, len(words)), bounds.tolist()
            slot_of_rare = np.zeros(len(words), np.int32)
            for i in np.flatnonzero(ranks == n_words).tolist():
                slot_of_rare[i] = slot_of(words[i], n_slots)
            ranks = ranks[codes]
            for a, b in zip(bounds, bounds[1:]):
                ids = np.append(ranks[a:b], np.int32(0))
                numbers, at = in_model[ids], np.flatnonzero(ids == n_words)
                rare = codes[a:b][at]
                slot = slot_of_rare[rare]
                numbers[at] += slot
                rare = [words[i] for i in rare.tolist()]
                yield numbers, len(ids), int(is_known[ids].sum()), float(base_log[ids].sum()), float(tail_log[ids].sum() - slot_log[slot].sum()), rare

        def finished(kept: list[pa.RecordBatch], held: list[tuple]) -> pa.RecordBatch:
            numbers, n_tokens, n_known, base, tail, rare = zip(*held)
            rows = pa.concat_batches(kept)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32)
            columns = [
                *rows.columns,
                pa.array(n_tokens, pa.int64()),
                pa.array(n_known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(score_docs(model, list(numbers)) / np.log(10) + np.array(tail)),
                pa.ListArray.from_arrays(pa.array(ends), string_array([w for r in rare for w in r])),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=_SCORED)

        kept, held, size = [], [], 0
        for part in (part for batch in batches for part in parts(batch, 3)):
            keys, first = part.select([0, 1, 2]), 0
            for i, found in enumerate(encoded(part.column(3))):
                held.append(found)
                size += found[1]
                if size >= CHUNK_TOKENS:
                    yield finished([*kept, keys.slice(first, i + 1 - first)], held)
                    kept, held, size, first = [], [], 0, i + 1
            kept.append(keys.slice(first))
        if held:
            yield finished(kept, held)

    rows = base.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    scored = keep(spark, rows.mapInArrow(run, _SCORED_FIELDS), "scored")
    # the listed words are in the parts already; the counts of all others are joined
    others = scored.select("row", F.explode("rare").alias("word"))
    c = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    looked_up = others.join(counts, "word", "left").groupBy("row").agg(
        F.count_if(F.col("n") > 0).alias("known_"),
        F.sum(F.log10((c + 0.5) / F.lit(float(divisor)))).alias("base_"),
        F.sum(F.log10(c + 0.5)).alias("tail_"),
    )
    joined = scored.drop("rare").join(looked_up, "row", "left")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0.0))
    return joined.select(
        F.col("doc_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base_")).alias("base_score"),
        (F.col("score") + zero("tail_")).alias("score"),
    )
