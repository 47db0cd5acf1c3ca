"""Words of UTF-8 bytes: their spans and 64-bit hashes, in numpy over many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

from orderloom.llm.shingles import mix

#: Maps A-Z to a-z and leaves every other byte, those of longer characters included.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Words beyond this many bytes are hashed one by one.
LONG = 512
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes whose entry of ``inside`` (256 booleans) is true."""
    flags = np.zeros(data.size + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    edges = np.flatnonzero(np.diff(flags))
    return edges[::2], edges[1::2]


def span_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per span, of its bytes and its length; eight bytes at a time for all spans together."""
    padded = text + bytes(8)
    eights = np.ndarray(len(text) + 1, dtype="<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    out = lengths.astype(np.uint64) * _ODD
    left = np.flatnonzero(lengths <= LONG)
    at = 0
    while left.size:
        taken = np.minimum(lengths[left] - at, 8)
        out[left] = mix(out[left] * _ODD + (eights[starts[left] + at] & _MASKS[taken]))
        at += 8
        left = left[lengths[left] > at]
    for i in np.flatnonzero(lengths > LONG):
        out[i] = int.from_bytes(hashlib.blake2b(text[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def text_hash(text: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def sequence_hash(parts: list[np.ndarray], seed: np.uint64) -> np.ndarray:
    """A hash of the sequence of each place of ``parts``, of its length and of ``seed``."""
    total = np.full(parts[0].size, seed ^ np.uint64(len(parts)), dtype=np.uint64)
    for part in parts:
        total = mix(total * _ODD + part)
    return total
