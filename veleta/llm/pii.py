"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans (email, ip, card, phone). A conditional random
field then labels the tokens of a document that hold digits or "@": each token
has evidence of its own (its shape, the words before it and the base spans on
it), neighbours in the text are joined by chain edges, and equal or similar
tokens anywhere in the document by skip edges. Loopy message passing lets the
label of one mention reach the others: a number that is written once as a
phone number and later without its plus sign becomes a phone number there too.
Beside the four kinds of the patterns the field knows secrets: long runs of
letters and digits, announced by a word such as "token". The field runs on every
document that has a token; what it labels with certainty (`CERTAIN`) is added as
spans, and base spans are never changed.

Tokens are the base spans, words with "@" (cut at commas, quotes and brackets),
long runs of letters and digits, and numbers. Numbers stand apart at blanks, so
that each one in a list is a token of its own. Parts written with blanks between
them have several readings; parts that together give the digits of a base span,
or of a number without blanks elsewhere in the text, are read as one (the
leftmost, longest reading first), then short parts that together are similar to
a base span, then short parts between others, if they have 8 to 19 digits.
Tokens never overlap.

Skip edges link a token to the previous one with the same key and to the first
one, so a token repeated m times has 2m edges, not m * m; the first token of a
key is linked to the first and the last of those it is similar to. Numbers are
similar when one ends in the other, nine digits or more, addresses when they
share the part before "@". Texts are read whole; only documents with a digit or "@" come to a
pattern at all.

The weights are learned: base spans label their tokens. A token without a base
span has no label, unless a skip edge or the shape of a secret could give it
one: that is what the field is to find out, so it is hidden from learning. The
weights maximise the mean pseudo-likelihood of the labels given the labels
around them, with a normal prior around `WEIGHTS` of strength `PRIOR`. Tokens
are counted by their features over all documents; every Newton step is a sum
over that table of counts, taken where its partitions lie.

Defined results: null text counts as empty; an empty text has no spans;
repeated rows and tied identifiers are labelled row by row; an empty table
gives an empty result; further columns of the input are dropped by `detect`
except the identifier column and kept by `redact`.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.llm.shared import forget, keep, small_batches

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the base spans.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_EMAIL_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
#: Kinds that the field labels.
LABELS = (*KINDS, "secret")
#: Tokens of the field: words with "@", long runs that hold letters and digits, and digits with the marks that numbers are written with.
_WORD = re.compile(r"[^\x20\x09-\x0D,;<>()\[\]{}\"|]+")
_RUN = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
_LETTER = re.compile(r"[A-Za-z]")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])+")
#: What stands between the blanks of a number.
_PART = re.compile(r"\+?\(?[0-9](?:[().-]{0,2}[0-9])*")
#: A number of so many digits is a token; joined parts have as many as a card at most.
LEAST_DIGITS, MOST_DIGITS = 8, 19

Span = tuple[str, int, int]


@dataclass(frozen=True)
class Weights:
    """Log potentials of the field."""

    other: float = 2.5  # no label
    shape: float = 1.0  # the token has the form of the kind
    cue: float = 1.0  # a word before the token names the kind
    chain: float = 0.2  # neighbours in the text agree
    same: float = 5.0  # tokens with the same key agree
    similar: float = 3.0  # numbers that end in the same digits agree
    secret_shape: float = 4.0  # shape and cue of a secret, which no pattern of its own labels
    secret_cue: float = 6.0


#: Means of the prior.
WEIGHTS = Weights()
#: Log potential that holds a token to the kind of its base span.
HELD = 25.0
#: Weight of the prior against the mean log-likelihood of a token, whatever the number of tokens.
PRIOR = 1e-3
#: Feature patterns that a task counts before it hands them on.
HELD_PATTERNS = 20_000
#: A span is added where its label has at least this probability.
CERTAIN = 0.9
ROUNDS = 12
#: Words that announce a kind.
CUES = {
    "email": {"mail", "email", "e-mail", "courriel", "correo"},
    "ip": {"ip", "host", "server", "addr"},
    "card": {"card", "visa", "karte", "carte", "tarjeta", "cc"},
    "phone": {"phone", "tel", "tel.", "call", "fax", "mobile", "telefon", "téléphone", "teléfono"},
    "secret": {"token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "api-key", "bearer", "passwort", "contraseña"},
}


def luhn(digits: str) -> bool:
    odd = [int(c) for c in digits[-1::-2]]
    even = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(odd) + sum(d - 9 if d > 9 else d for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, tried only around each "@"."""
    pattern, done, at = PATTERNS["email"], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        m = pattern.match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Base spans by kind and start; a match that fails its test is dropped and not tried again."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in PATTERNS["ip"].finditer(text) if "." in text else ():
        if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in PATTERNS["card"].finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in PATTERNS["phone"].finditer(text) if "+" in text else ():
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def _is_secret(token: str) -> bool:
    """Whether a token has the form of a secret."""
    return bool(_RUN.fullmatch(token) and _DIGIT.search(token) and _LETTER.search(token))


def _key(token: str) -> str:
    """What repeats of a token share: an address in lower case, a secret as it is, the digits of a number."""
    if "@" in token:
        return token.lower().rstrip(".,;:!?)")
    return token if _is_secret(token) or PATTERNS["ip"].fullmatch(token) else _NOT_DIGIT.sub("", token)


def _ending(key: str) -> str | None:
    """What similar keys share: the part of an address before "@", the last nine digits of a number."""
    if "@" in key:
        name = key.partition("@")[0]
        return f"{name}@" if len(name) >= 4 else None
    return key[-9:] if len(key) >= 9 and key.isdigit() else None


def _similar(a: str, b: str) -> bool:
    """Numbers of which one ends in the other, nine digits or more, or addresses of one name."""
    if "@" in a or "@" in b:
        return _ending(a) is not None and _ending(a) == _ending(b)
    n = min(len(a), len(b))
    return n >= 9 and a[-n:] == b[-n:]


def _shape(kind: str, token: str, key: str) -> bool:
    if kind == "email":
        return "@" in token and "." in token
    if kind == "ip":
        return token.count(".") == 3
    if kind == "card":
        return key.isdigit() and 16 <= len(key) <= 19 and luhn(key)
    if kind == "secret":
        return _is_secret(token)
    return token.startswith("+") and 8 <= len(key) <= 15


Edge = tuple[int, int, str]


def _clear(found: Iterable[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Of places in order those that touch none of the taken ones."""
    k = 0
    for a, b in found:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k == len(taken) or taken[k][0] >= b:
            yield a, b


Part = tuple[int, int, str]


def _joined_parts(parts: list[Part], free: list[bool], fits) -> Iterator[tuple[int, int]]:
    """Leftmost, longest readings of several free parts as one number; their parts are free no more."""
    i = 0
    while i < len(parts):
        digits, best, j = "", i, i
        while j < len(parts) and free[j] and len(digits) + len(parts[j][2]) <= MOST_DIGITS:
            digits += parts[j][2]
            if j > i and fits(digits):
                best = j
            j += 1
        if best > i:
            yield parts[i][0], parts[best][1]
            free[i : best + 1] = [False] * (best + 1 - i)
        i = best + 1


def _numbers(text: str, taken: list[tuple[int, int]], base: set[str]) -> Iterator[tuple[int, int]]:
    """Places of the numbers that touch no taken place, given the digits of the base spans."""
    groups: list[list[Part]] = []
    for m in _NUMBER.finditer(text):
        if len(_NOT_DIGIT.sub("", m.group())) < LEAST_DIGITS:
            continue
        parts = [p.span() for p in _PART.finditer(text, *m.span())]
        clear = set(_clear(parts, taken[max(0, bisect_left(taken, m.span()) - 1) :])) if taken else set(parts)
        groups.append([])
        for a, b in parts:
            if (a, b) in clear:
                groups[-1].append((a, b, _NOT_DIGIT.sub("", text[a:b])))
            else:
                groups.append([])
    known = base | {d for g in groups for _, _, d in g if LEAST_DIGITS <= len(d) <= MOST_DIGITS}
    endings = {d[i:] for d in base for i in range(len(d) - 8)}  # of nine digits or more
    alike = lambda d: d in endings or any(d[i:] in base for i in range(len(d) - 8))
    for g in groups:
        free = [True] * len(g)
        if len(g) > 1 and known:
            yield from _joined_parts(g, free, known.__contains__)
        long = [len(d) >= LEAST_DIGITS for _, _, d in g]
        yield from ((a, b) for (a, b, _), f, x in zip(g, free, long) if f and x)
        free = [f and not x for f, x in zip(free, long)]
        if base:
            yield from _joined_parts(g, free, alike)
        rest: list[Part] = []
        for part, f in [*zip(g, free), (None, False)]:
            if f:
                rest.append(part)
            elif rest:
                if LEAST_DIGITS <= sum(len(d) for _, _, d in rest) <= MOST_DIGITS:
                    yield rest[0][0], rest[-1][1]
                rest = []


def _tokens(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Places of the tokens in order; where they would overlap, base spans go first, then addresses, secrets and numbers."""
    found: list[tuple[int, int]] = []
    for place in sorted((a, b) for _, a, b in spans):
        if not found or place[0] >= found[-1][1]:
            found.append(place)
    if "@" in text:
        words = ((m.start(), m.start() + len(m.group().rstrip(".:!?'"))) for m in _WORD.finditer(text) if "@" in m.group())
        found = sorted([*found, *_clear((w for w in words if "@" in text[w[0] : w[1]]), found)])
    if _DIGIT.search(text):
        found = sorted([*found, *_clear((m.span() for m in _RUN.finditer(text) if _is_secret(m.group())), found)])
        digits = {_NOT_DIGIT.sub("", text[a:b]) for kind, a, b in spans if kind in ("card", "phone")}
        found = sorted([*found, *_numbers(text, found, digits)])
    return found


def _labels(tokens: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """Number of the kind of a base span on each token, 0 without one, -1 where several kinds meet."""
    by_kind = [sorted((a, b) for k, a, b in spans if k == kind) for kind in KINDS]  # spans of one kind do not overlap
    out = []
    for a, b in tokens:
        on = [n for n, places in enumerate(by_kind, 1) if (j := bisect_left(places, (b,))) and places[j - 1][1] > a]
        out.append(on[0] if len(on) == 1 else -1 if on else 0)
    return out


def _features(text: str, tokens: list[tuple[int, int]]) -> np.ndarray:
    """Of each token, for no label and for each kind: shape and cue, and the same of a secret."""
    out = np.zeros((len(tokens), len(LABELS) + 1, 4), np.int8)
    for i, (a, b) in enumerate(tokens):
        key = _key(text[a:b])
        before = set(re.findall(r"[^\s:=]+", text[max(0, a - 40) : a].lower())[-2:])
        for n, k in enumerate(LABELS, 1):
            at = 2 if k == "secret" else 0
            out[i, n, at : at + 2] = _shape(k, text[a:b], key), bool(before & CUES[k])
    return out


def _edges(keys: list[str]) -> list[Edge]:
    edges: list[Edge] = [(i, i + 1, "chain") for i in range(len(keys) - 1)]
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    heads: dict[str, int] = {}  # first and last token of each ending
    tails: dict[str, int] = {}
    for i, k in enumerate(keys):
        if k in last:
            edges.append((last[k], i, "same"))
            if first[k] != last[k]:
                edges.append((first[k], i, "same"))
        else:
            first[k] = i
            alike = {heads.get(_ending(k)), tails.get(_ending(k))} - {None}
            edges += [(j, i, "similar") for j in sorted(alike) if _similar(keys[j], k)]
        last[k] = i
        if (end := _ending(k)) is not None:
            heads.setdefault(end, i)
            tails[end] = i
    return edges


_EDGE_KINDS = ("chain", "same", "similar")


def token_patterns(text: str) -> Iterator[tuple[str, int]]:
    """Feature pattern and label of each token that learning sees.

    Features: for each label the token's shapes and cues, and its neighbours
    with that label by edge kind; written are those that are not 0.
    """
    spans = base_spans(text)
    tokens = _tokens(text, spans)
    if not tokens:
        return
    labels = _labels(tokens, spans)
    edges = _edges([_key(text[a:b]) for a, b in tokens])
    hidden = {y for i, j, kind in edges if kind != "chain" for x, y in ((i, j), (j, i)) if labels[x] > 0 and not labels[y]}
    hidden |= {i for i, (a, b) in enumerate(tokens) if not labels[i] and _is_secret(text[a:b])}
    around = np.zeros((len(tokens), len(LABELS) + 1, len(_EDGE_KINDS)), np.int64)
    for i, j, kind in edges:
        for x, y in ((i, j), (j, i)):
            if labels[y] >= 0 and y not in hidden:
                around[x, labels[y], _EDGE_KINDS.index(kind)] += 1
    rows = np.concatenate([_features(text, tokens), around], 2).reshape(len(tokens), -1)
    for i, (row, label) in enumerate(zip(rows, labels)):
        if label >= 0 and i not in hidden:
            at = row.nonzero()[0]
            yield " ".join(f"{k}:{v}" for k, v in zip(at.tolist(), row[at].tolist())), label


def features_of(pattern: str) -> np.ndarray:
    """The features that a pattern is written for, a row for each label."""
    row = np.zeros((len(LABELS) + 1) * (4 + len(_EDGE_KINDS)))
    for k, _, v in (x.partition(":") for x in pattern.split()):
        row[int(k)] = int(v)
    return row.reshape(len(LABELS) + 1, -1)


#: Fields of Weights in the order of the features, after that of no label.
_FIELDS = ("other", "shape", "cue", "secret_shape", "secret_cue", *_EDGE_KINDS)


def _texts(batches: Iterable[pa.RecordBatch], column: int, rows: int = 64) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of batches with the texts of a column."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).to_pylist()


def _pattern_sums(patterns: list[str], labels: np.ndarray, n: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Tokens, and the gradient and the negative second derivatives of their log-likelihood, in one vector."""
    width, total = len(LABELS) + 1, np.zeros(1 + len(w) + len(w) ** 2)
    for at in range(0, len(patterns), 4096):
        x = np.stack([features_of(p) for p in patterns[at : at + 4096]])
        none = np.zeros((len(x), width, 1))
        none[:, 0] = 1
        x = np.concatenate([none, x], 2)
        y, times = labels[at : at + 4096], n[at : at + 4096]
        p = np.exp((s := x @ w) - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        mean = (p[:, :, None] * x).sum(1)
        gradient = (times[:, None] * (x[np.arange(len(x)), y] - mean)).sum(0)
        spread = np.einsum("i,ij,ijk,ijl->kl", times, p, x, x) - np.einsum("i,ik,il->kl", times, mean, mean)
        total += np.concatenate([[times.sum()], gradient, spread.ravel()])
    return total


def pattern_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """pattern, label, n over the tokens of all documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for _, texts in _texts(batches, 0):
            for text in texts:
                counts.update(token_patterns(text))
            if len(counts) > HELD_PATTERNS:  # handed on early, summed later
                yield _pattern_batch(counts)
                counts.clear()
        if counts:
            yield _pattern_batch(counts)

    found = docs.filter(F.col(text_col).rlike("[0-9@]")).select(F.col(text_col).alias("text"))
    return found.mapInArrow(run, "pattern string, label int, n long").groupBy("pattern", "label").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", steps: int = 50) -> Weights:
    """Weights by maximum mean pseudo-likelihood over the tokens of all documents, with the prior."""
    spark = docs.sparkSession
    small_batches(spark)
    table = keep(spark, pattern_counts(docs, text_col), "patterns")
    prior = np.array([getattr(WEIGHTS, f) for f in _FIELDS])

    def sums(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                total = total + _pattern_sums(batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(float), w)
            if not isinstance(total, int):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "value"])

        out = np.zeros(1 + len(w) + len(w) ** 2)
        for r in table.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():  # one row a place
            out[r.place] = r.value
        return out

    w = prior.copy()
    for _ in range(steps):  # Newton steps on a concave function of a few weights
        found = sums(w)
        if not found[0]:
            break
        gradient = found[1 : 1 + len(w)] / found[0] - PRIOR * (w - prior)
        spread = found[1 + len(w) :].reshape(len(w), len(w)) / found[0]
        step = np.linalg.solve(spread + PRIOR * np.eye(len(w)), gradient)
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))  # far steps are cut short
        if np.abs(step).max() < 1e-6:
            break
    forget(spark, table)
    return Weights(**dict(zip(_FIELDS, map(float, w))))


def _pattern_batch(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
        names=["pattern", "label", "n"],
    )


def marginals(evidence: np.ndarray, edges: list[tuple[int, int, float]], rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities by loopy sum-product in log space, all messages at once, damped."""
    n, labels = evidence.shape
    if not edges:
        p = np.exp(evidence - evidence.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)
    e = len(edges)
    a = np.array([x[0] for x in edges])
    b = np.array([x[1] for x in edges])
    src, dst = np.concatenate([a, b]), np.concatenate([b, a])
    gain = np.exp(np.tile(np.array([x[2] for x in edges]), 2))[:, None] - 1.0
    back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
    message = np.zeros((2 * e, labels))
    for _ in range(rounds):
        belief = evidence.copy()
        np.add.at(belief, dst, message)
        out = belief[src] - message[back]
        out = np.exp(out - out.max(1, keepdims=True))
        # sum over source labels of out * (exp(weight) if equal else 1)
        new = np.log(out.sum(1, keepdims=True) + gain * out)
        new -= new.max(1, keepdims=True)
        if np.abs(new - message).max() < 1e-4:
            message = new
            break
        message = 0.3 * message + 0.7 * new
    belief = evidence.copy()
    np.add.at(belief, dst, message)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(text: str, spans: list[Span], w: Weights = WEIGHTS) -> list[Span]:
    """Spans that the field adds to the base spans."""
    tokens = _tokens(text, spans)
    labels = _labels(tokens, spans)
    if 0 not in labels:
        return []
    evidence = _features(text, tokens) @ np.array([w.shape, w.cue, w.secret_shape, w.secret_cue])
    evidence[:, 0] += w.other
    for i, label in enumerate(labels):
        if label:
            evidence[i, max(label, 0)] += HELD
    edges = [(i, j, getattr(w, kind)) for i, j, kind in _edges([_key(text[a:b]) for a, b in tokens])]
    p = marginals(evidence, edges)
    best = p.argmax(1)
    return [(LABELS[best[i] - 1], *tokens[i]) for i, label in enumerate(labels) if not label and best[i] and p[i, best[i]] >= CERTAIN]


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (LABELS.index(s[0]), s[1], s[2])))


_FOUND = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
SPANS_TYPE = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"


def _found(text: str, w: Weights = WEIGHTS) -> list[dict]:
    base = base_spans(text)
    return [
        {"kind": k, "start": a, "end": b, "base": is_base}
        for is_base, spans in ((True, base), (False, added_spans(text, base, w)))
        for k, a, b in spans
    ]


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: Weights = WEIGHTS) -> DataFrame:
    """id_col and `spans`: kind, start, end (code points, end exclusive), and whether a pattern found it."""
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches, 1):
            spans = [[] if t is None else _found(t, weights) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_FOUND))], names=[id_col, "spans"])

    # only texts with a digit or "@" are handed over; an other text has no spans
    text = F.when(F.col(text_col).rlike("[0-9@]"), F.col(text_col))
    return docs.select(F.col(id_col), text.alias("text")).mapInArrow(run, f"`{id_col}` {kind}, spans {SPANS_TYPE}")


def _joined(spans, only_base: bool):
    if only_base:
        spans = F.filter(spans, lambda s: s["base"])
    order = F.array(*[F.lit(k) for k in LABELS])
    keyed = F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ",")


def report(detected: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Base counts by kind, the digest of the base spans, all spans, how many they are, and how many the field added."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return detected.select(
        id_col,
        *[count(k) for k in KINDS],
        F.sha2(_joined(F.col("spans"), True), 256).alias("base_sha256"),
        _joined(F.col("spans"), False).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


def redact_text(text: str, w: Weights = WEIGHTS) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the earlier, longer one."""
    spans = sorted(((s["start"], -s["end"], s["kind"]) for s in _found(text, w)))
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = -b
        elif -b > at:
            at = -b  # an overlap is hidden too
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, text_col: str = "text", weights: Weights = WEIGHTS) -> DataFrame:
    """`docs` with personal data replaced in the text; other columns stay as they are."""
    schema, at = docs.schema, docs.columns.index(text_col)
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches, at):
            texts = [t if t is None else redact_text(t, weights) for t in texts]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)
