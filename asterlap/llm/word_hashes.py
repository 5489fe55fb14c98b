"""Hashes of words and of windows of words, for whole batches of texts at a time."""

import numpy as np
import xxhash

#: Odd multipliers for the two halves of a window's hash.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MASK = 2**64 - 1


class WordHashes(dict):
    """128-bit hashes of words, as two columns of 64 bits; remembers a bounded number of words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit, self.raw = limit, bytearray()

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.raw += xxhash.xxh3_128_digest(word)
        return place

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
            self.raw = bytearray()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(bytes(self.raw), np.uint64).reshape(-1, 2)[places]


def rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive entries, by doubling: about 2 log2(size) passes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power = lambda k: np.uint64(pow(base, k, 2**64))
    block, width, out, have, left = hashes, 1, None, 0, size
    while left:
        if left & 1:
            out = block if out is None else out[: len(block) - have] + power(have) * block[have : have + len(out)]
            have += width
        left >>= 1
        if left:
            block = block[:-width] + power(width) * block[width:]
            width *= 2
    return out[:n]


def batch_windows(texts: list[bytes], size: int, hashes: WordHashes) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, the index of its first word among all words, the start (index among all words) of every
    window of one text, and the two halves of its hash."""
    words = [t.split() for t in texts]  # bytes are split at ASCII white space only
    counts = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(counts)
    flat = [w for ws in words for w in ws]
    h = hashes.of(flat)
    inside = np.repeat(ends, counts) - np.arange(len(flat)) >= size
    starts = np.flatnonzero(inside)
    pair = np.empty((len(starts), 2), np.uint64)
    for half, base in enumerate(BASES):
        if len(starts):
            pair[:, half] = rolling(np.ascontiguousarray(h[:, half]), size, base)[starts]
    return words, ends - counts, starts, pair
