"""Word shingles as 64-bit hashes, in numpy over the bytes of one text."""

from __future__ import annotations

import hashlib

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word ``[^\\x20\\x09-\\x0D]+``, A-Z lowered."""
    data = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
    upper = (data >= 65) & (data <= 90)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    places = np.flatnonzero(inside)
    if not places.size:
        return np.zeros(0, dtype=np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], np.diff(places) > 1]))
    lengths = np.diff(np.append(starts, places.size))
    within = np.arange(places.size) - np.repeat(starts, lengths)
    letters = (data + upper.astype(np.uint8) * 32)[places].astype(np.uint64)
    terms = mix((letters + np.uint64(1)) * _ODD + within.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mix(np.add.reduceat(terms, starts) + lengths.astype(np.uint64) * _ODD)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of fewer words the whole sequence; of none nothing."""
    each = word_hashes(text)
    if not each.size:
        return each
    span = min(words, each.size)
    total = np.full(each.size - span + 1, span, dtype=np.uint64)
    for k in range(span):
        total = mix(total * _ODD + each[k : each.size - span + 1 + k])
    return np.unique(total)


def digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()
