"""Word shingles of whole batches of texts as numpy arrays, without a Python object for each word."""

from __future__ import annotations

import numpy as np

#: Bytes of text that are hashed at once; a longer word is hashed at once all the same.
SEGMENT = 1 << 17

_ODD = np.uint64(0x9E3779B97F4A7C13)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_TIMES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: A random number for each byte, the same for A-Z and a-z.
_BYTE = np.random.default_rng(20_240_607).integers(0, 1 << 64, 256, dtype=np.uint64)[_LOWER]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray, times: np.uint64 = _TIMES[1]) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on all."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * times
        x = (x ^ (x >> np.uint64(29))) * _TIMES[0]
        return x ^ (x >> np.uint64(32))


def _power(n: int) -> list[np.ndarray]:
    """At least ``n`` powers of the base, and of its inverse."""
    while len(_powers[0]) < n:
        size = len(_powers[0])
        with np.errstate(over="ignore"):
            for i, base in enumerate((_ODD, _INVERSE)):
                _powers[i] = np.concatenate([_powers[i], _powers[i] * np.uint64(pow(int(base), size, 1 << 64))])
    return _powers


def _hash_words(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes and starts of the words of ``data``; where ``first`` is set a text begins."""
    word = ~_SPACE[data]
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    after[:-1] &= ~first[1:]
    start, end = np.flatnonzero(word & (~before | first)), np.flatnonzero(word & ~after) + 1
    power, inverse = _power(n)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:n], out=sums[1:])
        return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)), start


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of texts that lie one behind the other, and how many precede each text.

    Words are runs of anything but ASCII white space, with A-Z in lower case.
    The bytes are taken a segment at a time, cut at white space.
    """
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    hashes, starts, at = [], [], 0
    while at < n:
        end = min(n, at + SEGMENT)
        while end < n and not _SPACE[data[end]]:
            gap = np.flatnonzero(_SPACE[data[end : end + 4096]] | first[end : min(n, end + 4096)])
            if len(gap):
                end += int(gap[0])
                break
            end = min(n, end + 4096)
        h, s = _hash_words(data[at:end], first[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def _sets_of(data: np.ndarray, offsets: np.ndarray, n: int):
    hashes, words = word_hashes(data, offsets)
    with np.errstate(over="ignore"):
        runs = np.full(max(0, len(hashes) - n + 1), np.uint64(n))
        for i in range(n):
            runs = mixed(runs + hashes[i : i + len(runs)])
        for begin, end in zip(words[:-1].tolist(), words[1:].tolist()):
            if end - begin >= n:
                yield np.unique(runs[begin : end - n + 1])
            elif end > begin:
                whole = np.full(1, np.uint64(end - begin))
                for i in range(begin, end):
                    whole = mixed(whole + hashes[i : i + 1])
                yield whole
            else:
                yield runs[:0]


def shingle_sets(column, n: int, most: int = 4 * SEGMENT):
    """For each text of an Arrow column the sorted distinct 64-bit hashes of its ``n``-word shingles.

    A text of fewer words is one shingle; one without words, or null, has none.
    Texts are taken together as long as they have ``most`` bytes.
    """
    import pyarrow as pa

    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield from _sets_of(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], n)
        at = end


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted sets."""
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
