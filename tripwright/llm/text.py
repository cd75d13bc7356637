"""Words, hashes and worker-wide caches shared by the operators."""

from __future__ import annotations

import sys
import types

import numpy as np
import xxhash

#: Words whose hashes a worker keeps.
MEMO = 400_000


def worker_cache(name: str, make):
    """``make()`` once per Python worker. Functions of this package reach workers by value, so a module's own
    globals would start anew with every task."""
    module = sys.modules.setdefault("_tripwright_worker", types.ModuleType("_tripwright_worker"))
    if not hasattr(module, name):
        setattr(module, name, make())
    return getattr(module, name)


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    memo = worker_cache("word_hashes", WordHashes)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


#: Words of up to this many bytes are hashed together, longer ones each by the library.
TOGETHER = 16
_LOW = np.uint64(0xFFFFFFFF)


def _short_hashes(head: np.ndarray, tail: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH3 (64 bits, seed 0) of words of 1 to 16 bytes, from their first eight bytes (with what follows) and the eight
    that end with their last."""
    u = np.uint64
    out = np.empty(len(sizes), np.uint64)
    n = sizes.astype(np.uint64)
    at = np.flatnonzero(sizes <= 3)
    if len(at):
        h, k = head[at], n[at]
        x = (h & u(255)) << u(16) | ((h >> (k >> u(1) << u(3))) & u(255)) << u(24) | ((h >> (k - u(1) << u(3))) & u(255)) | k << u(8)
        x ^= u(0x87275A9B)
        x = (x ^ x >> u(33)) * u(0xC2B2AE3D27D4EB4F)
        x = (x ^ x >> u(29)) * u(0x165667B19E3779F9)
        out[at] = x ^ x >> u(32)
    at = np.flatnonzero((sizes > 3) & (sizes <= 8))
    if len(at):
        x = ((tail[at] >> u(32)) + (head[at] << u(32))) ^ u(0xC73AB174C5ECD5A2)
        x ^= (x << u(49) | x >> u(15)) ^ (x << u(24) | x >> u(40))
        x *= u(0x9FB21C651E98DF25)
        x = (x ^ (x >> u(35)) + n[at]) * u(0x9FB21C651E98DF25)
        out[at] = x ^ x >> u(28)
    at = np.flatnonzero(sizes > 8)
    if len(at):
        a, b = head[at] ^ u(0x6782737BEA4239B9), tail[at] ^ u(0xAF56BC3B0996523A)
        low_a, high_a, low_b, high_b = a & _LOW, a >> u(32), b & _LOW, b >> u(32)
        low, side = low_a * low_b, high_a * low_b
        cross = (low >> u(32)) + (side & _LOW) + low_a * high_b
        high = (side >> u(32)) + (cross >> u(32)) + high_a * high_b
        x = n[at] + a.byteswap() + b + (high ^ (cross << u(32) | low & _LOW))
        x = (x ^ x >> u(37)) * u(0x165667919E3779F9)
        out[at] = x ^ x >> u(32)
    return out


def text_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of the words of all texts, in lower case and cut at ASCII blanks, and how many each text has."""
    joined = b"\n".join([b"\n" * 8, *texts, b""]).lower()
    raw = np.frombuffer(joined, np.uint8)
    blank = (raw - np.uint8(9) < 5) | (raw == 32)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begin, end = edges[::2], edges[1::2]
    sizes = end - begin
    # eight bytes from each byte on; the last ones are never read as a word's first
    eight = np.ndarray(len(raw), "<u8", joined + b"\0" * 8, strides=(1,))
    out = _short_hashes(eight[begin], eight[end - 8], sizes)
    long = np.flatnonzero(sizes > TOGETHER)
    if len(long):
        out[long] = word_hashes([joined[i:j] for i, j in zip(begin[long].tolist(), end[long].tolist())])
    ends = 8 + np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return out, np.diff(np.searchsorted(begin, ends), prepend=0)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` consecutive words; with fewer words, one for the whole sequence."""
    n = len(hashes)
    if n == 0:
        return hashes
    span = min(n, width)
    out = np.full(n - span + 1, span, np.uint64)
    for i in range(span):
        out = mix((out ^ hashes[i : i + n - span + 1]) * np.uint64(0x9E3779B97F4A7C15))
    return out


def seeds(n: int, key: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
