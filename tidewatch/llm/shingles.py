"""Word shingles of many texts at once, as 64-bit hashes, in numpy over the batch's bytes."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa

SEED = 20_240_601
_draw = np.random.default_rng(SEED)
_BYTE = _draw.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE, _STEP, _SALT = (np.uint64(int(x) | 1) for x in _draw.integers(1, 2**63, 3, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A random number for each byte; the lowered one gives A-Z the numbers of a-z.
EXACT, LOWERED = _BYTE, _BYTE[_LOWER]
#: Bytes that belong to a word: all but ASCII blanks; letters, digits and all beyond ASCII.
UNBROKEN = np.ones(256, bool)
UNBROKEN[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_marks(data: np.ndarray, at: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and which ones begin a word; a text's start ends the word before."""
    solid = parts[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    first[heads] = solid[heads]
    return solid, first


def word_spans(data: np.ndarray, at: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word."""
    solid, first = word_marks(data, at, parts)
    stops = np.concatenate([~solid, [True]])
    stops[at] = True
    starts, stops = np.flatnonzero(first), np.flatnonzero(stops)
    return starts, stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts


def word_hashes(data: np.ndarray, at: np.ndarray, parts: np.ndarray = UNBROKEN, numbers: np.ndarray = LOWERED) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (a run of bytes in `parts` within a text) and, for each text, where its words begin in them.

    The value of a word is the sum of a random number for each byte times a power for its place,
    modulo 2**64, mixed; equal words get equal hashes on every machine. Long words of two letters can be
    made to collide, so this is for features and samples; links use `sure_word_hashes`.
    """
    solid, first = word_marks(data, at, parts)
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    place = np.arange(len(data), dtype=np.int64)
    place -= np.maximum.accumulate(np.where(first, place, 0))
    powers = np.full(int(place.max()) + 1, _BASE)
    powers[0] = 1
    values = numbers[data] * np.cumprod(powers)[place]
    values[~solid] = 0
    return mix(np.add.reduceat(values, starts)), bounds


def sure_word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `word_hashes` for words without blanks, A-Z lowered: the BLAKE2b of each distinct word, for which no equal pairs are known."""
    solid, first = word_marks(data, at, UNBROKEN)
    edge = first.copy()
    edge[1:] |= solid[1:] != solid[:-1]
    edge[:1] = True
    begin = np.flatnonzero(edge)
    bounds = np.searchsorted(np.flatnonzero(first), at)
    if not len(begin):
        return np.zeros(0, np.uint64), bounds
    offsets = pa.py_buffer(np.append(begin, len(data)).astype(np.int64))
    coded = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, offsets, pa.py_buffer(_LOWER[data].tobytes())]).dictionary_encode()
    own = np.frombuffer(b"".join([blake2b(w, digest_size=8).digest() for w in coded.dictionary.to_pylist()]), np.uint64)
    return own[coded.indices.to_numpy()[solid[begin]]], bounds


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: `size` words each, or all words if fewer; empty without words."""
    words, bounds = sure_word_hashes(data, at)
    joined = words + _SALT
    for k in range(1, size):
        joined = mix(joined[: len(words) - k] * _STEP) + words[k:] if len(words) > k else joined[:0]
    joined = mix(joined)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo >= size:
            out.append(np.unique(joined[lo : hi - size + 1]))
        elif hi > lo:
            one = words[lo : lo + 1] + np.uint64(hi - lo)
            for k in range(lo + 1, hi):
                one = mix(one * _STEP) + words[k : k + 1]
            out.append(mix(one ^ _SALT))
        else:
            out.append(words[:0])
    return out
