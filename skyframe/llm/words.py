"""Hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

BASE = 0xD1342543DE82EF95
#: Blank and \t to \r part words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Texts are joined up to this many bytes, and longer ones cut between words.
CHUNK = 1 << 19
#: Bytes of a word that is hashed on its own.
LONG = 64

def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of lower-case bytes.

    Eight bytes at a time enter a mix that is one to one for a given state, so words of up to
    eight bytes and one length never collide; longer words take an xxhash. Two given other words
    collide with probability 2^-64.
    """
    octets = np.frombuffer(data + bytes(8), np.uint8)
    gap = np.concatenate([[True], SPACE[octets[:-8]], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, size = edge[::2], edge[1::2] - edge[::2]
    out = mix(size.astype(np.uint64) * np.uint64(BASE))
    eights = np.ndarray(len(octets) - 7, "<u8", octets, strides=(1,))
    left, at = np.flatnonzero(size <= LONG), 0
    while len(left):
        rest = np.minimum(size[left] - at, 8).astype(np.uint64)
        part = eights[start[left] + at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * rest))
        out[left] = mix((out[left] ^ part) * np.uint64(BASE))
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]])
    return out, start


def _cuts(text: bytes) -> Iterator[bytes]:
    """A text in parts that end between words; a part is long only if a word is."""
    at = 0
    while len(text) - at > CHUNK:
        end = at + CHUNK
        while end < len(text) and not SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: Iterator[bytes]) -> Iterator[np.ndarray]:
    """For each text the hashes of its words, A-Z taken as a-z; in order."""
    held: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        hashes, start = _hash_words(b" ".join(held))
        first = np.cumsum([0, *[len(t) + 1 for t in held]])
        at = np.searchsorted(start, first)
        for i in range(len(held)):
            yield hashes[at[i] : at[i + 1]]

    for text in texts:
        text = text.lower()
        if len(text) > CHUNK:
            if held:
                yield from flush()
                held, size = [], 0
            yield np.concatenate([_hash_words(part)[0] for part in _cuts(text)])
            continue
        held.append(text)
        size += len(text)
        if size >= CHUNK:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct runs of ``k`` words as sorted hashes; of fewer words, the whole run as one."""
    if not len(words):
        return words
    n = min(k, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(BASE) + words[i : len(words) - n + 1 + i])
    return np.unique(out)
