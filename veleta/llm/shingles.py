"""Five-word shingles of whole texts as 64-bit hashes, vectorised over a batch of documents.

A word's hash is XXH3 of its bytes, which knows no structure of texts that makes
two hashes meet. A shingle's hash is a sum of its words' hashes,
each times an odd multiplier of its place, spread by a bijection.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from xxhash import xxh3_64_intdigest

from veleta.llm.text import byte_words, string_array, word_codes

SIZE = 5
# Odd multipliers of the places in a shingle, for the hash and for a second one.
_PLACES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_SECOND = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)
#: Bytes of text that are hashed at a time; a longer document is hashed by itself.
BATCH_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _grams(word: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of all windows of as many words as there are places."""
    n = max(0, len(word) - len(places) + 1)
    out = np.full(n, len(places), np.uint64)
    for k, p in enumerate(places if n else ()):
        out += word[k : k + n] * p
    return mix(out)


def firsts(ordered: np.ndarray) -> np.ndarray:
    """Where a sorted array begins a new value."""
    first = np.empty(len(ordered), bool)
    first[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return first


def _hash_batch(texts: list[bytes], second: bool) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    words, codes, bounds = word_codes(string_array(texts))
    word, sizes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))[codes], np.diff(bounds).tolist()
    grams = _grams(word, _PLACES)
    others = _grams(word, _SECOND) if second else None
    at = 0
    for n in sizes:
        if n >= SIZE:
            cut = slice(at, at + n - SIZE + 1)
            if second:
                order = np.argsort(grams[cut])
                found = grams[cut][order]
                first = firsts(found)
                yield found[first], others[cut][order[first]]
            else:
                found = np.sort(grams[cut])
                yield found[firsts(found)], None
        else:  # the whole sequence as one
            own = word[at : at + n]
            yield _grams(own, _PLACES[:n])[: min(n, 1)], _grams(own, _SECOND[:n])[: min(n, 1)] if second else None
        at += n


def _batched(texts: Iterable[bytes], second: bool) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > BATCH_BYTES:
            yield from _hash_batch(held, second)
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield from _hash_batch(held, second)


def hash_sets(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each UTF-8 text; A-Z count as a-z."""
    return (found for found, _ in _batched(texts, False))


def double_hash_sets(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same, and beside them second hashes of the same shingles by other multipliers."""
    return _batched(texts, True)


def word_shingles(text: bytes) -> set[tuple[bytes, ...]]:
    """The shingles themselves."""
    w = byte_words(text)
    if len(w) < SIZE:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(SIZE))))
