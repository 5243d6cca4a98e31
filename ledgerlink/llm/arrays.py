"""Texts of a batch as one array: runs of characters, their hashes, windows of them."""

from __future__ import annotations

import hashlib

import numpy as np

from ledgerlink.llm.sketch import mix

#: Lengths above this, in bytes, are hashed one by one.
_LONG = 1024
_MASKS = np.array([2 ** (8 * n) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)


def odd_numbers(n: int, seed: int = 1) -> np.ndarray:
    """``n`` odd 64-bit numbers without relations to each other."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
               + np.uint64(seed)) | np.uint64(1)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def run_hashes(
    codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1
) -> np.ndarray:
    """64-bit hashes of slices of an array of bytes or code points.

    Eight bytes at a time are mixed into all bits of the hash before the next eight, so
    that no pattern of the characters cancels out.
    """
    width = codes.itemsize
    at, left = starts * width, (ends - starts) * width
    out = mix(left.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
    data = np.concatenate([codes.view(np.uint8), np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    long = np.flatnonzero(left > _LONG)
    for i in long.tolist():
        run = data[at[i] : at[i] + left[i]].tobytes()
        digest = hashlib.blake2b(run, digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    rows = np.flatnonzero((left > 0) & (left <= _LONG))
    at, left = at[rows], left[rows]
    while len(rows):
        out[rows] = mix(out[rows] ^ (eights[at] & _MASKS[np.minimum(left, 8)]))
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return out


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one array, each followed by a blank, and where each begins; at the
    end stands the total length."""
    codes = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    begin = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    return codes, begin


class Words:
    """Words of a batch of UTF-8 texts.

    ``inside`` says for each of the 256 bytes whether it belongs to words; the blank must
    not; A-Z count as lower case unless ``lower`` is false.  Words of text i are ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, texts: list[bytes], inside: np.ndarray, lower: bool = True) -> None:
        self.codes, begin = joined([t.lower() for t in texts] if lower else texts)
        self.starts, self.ends = runs(inside[self.codes])
        self.hashes = run_hashes(self.codes, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, begin)

    def bytes_of(self, i: int) -> bytes:
        return self.codes[self.starts[i] : self.ends[i]].tobytes()

    def window_hashes(self, width: int) -> np.ndarray:
        """Hash of the ``width`` words from each word on, whatever text they are in;
        shorter by ``width - 1`` than the words."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        out = np.full(n, width, dtype=np.uint64)
        for i, odd in enumerate(odd_numbers(width)):
            out += self.hashes[i : i + n] * odd
        return mix(out)


def byte_class(allowed) -> np.ndarray:
    """Table of the bytes for which ``allowed`` holds."""
    return np.array([bool(allowed(b)) for b in range(256)])


#: All but blanks and \x09 to \x0D.
NOT_BLANK = byte_class(lambda b: b != 0x20 and not 9 <= b <= 13)
#: Digits, letters a-z and everything beyond ASCII.
ALPHANUMERIC = byte_class(lambda b: 48 <= b < 58 or 97 <= b < 123 or b >= 128)
