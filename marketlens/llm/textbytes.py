"""Vectorised work on the UTF-8 bytes of an Arrow text column.

All functions take the concatenated bytes of many texts and the offsets that
part them, so that hashing costs a few array passes per byte and no Python
object per word. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in runs of about this size; each byte takes some hundred bytes of arrays meanwhile.
CHUNK_BYTES = 1 << 19
WORDS_IN_SHINGLE = 5

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_random = np.random.default_rng(20240501)
_BYTE_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = np.arange(256)
_LOWERED[65:91] += 32
_LOWER_CODES = _BYTE_CODES[_LOWERED]
_SHINGLE_FACTORS = _random.integers(1, 1 << 63, WORDS_IN_SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of every value (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated bytes and the offsets of the texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    texts = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first, end, bytes, offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word with A-Z lowered, and the index of its text.

    ``inside`` is a table of 256 flags: the bytes that words are made of. The
    default is every byte but ASCII white space.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    in_word = (~_SPACE if inside is None else inside)[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = in_word.copy()
    starts[1:] &= ~in_word[:-1] | first[1:-1]
    ends = in_word
    ends[:-1] &= ~in_word[1:] | first[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER_CODES[data] * powers(_BASE, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(data))[starts]
    hashes += (ends - starts).astype(np.uint64)
    return mix(hashes), np.searchsorted(offsets, starts, "right") - 1


def shingle_hashes(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all five-word shingles and their texts, in text order.

    A text of one to four words has its whole word sequence as one shingle.
    """
    k = WORDS_IN_SHINGLE
    counts = np.bincount(owner, minlength=n)
    if len(words) >= k:
        whole = owner[k - 1 :] == owner[: len(owner) - k + 1]
        long = np.zeros(len(words) - k + 1, np.uint64)
        for j, factor in enumerate(_SHINGLE_FACTORS):
            long += words[j : len(words) - k + 1 + j] * factor
        long, at = mix(long[whole]), owner[: len(owner) - k + 1][whole]
    else:
        long, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        begin = np.concatenate([[0], np.cumsum(counts)])[few]
        short = counts[few].astype(np.uint64) * np.uint64(_BASE)
        for j in range(k - 1):
            has = counts[few] > j
            short[has] += words[begin[has] + j] * _SHINGLE_FACTORS[j]
        long, at = np.concatenate([long, mix(short)]), np.concatenate([at, few])
        order = np.argsort(at, kind="stable")
        long, at = long[order], at[order]
    return long, at


def sequence_keys(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the word sequence of every text."""
    counts = np.bincount(owner, minlength=n)
    begin = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(words)) - begin[owner]
    keys = []
    for base, salt in ((_BASE, 0x1234567), (0xD6E8FEB86659FD93, 0x89ABCDEF)):
        terms = mix(words + np.uint64(salt)) * powers(base, int(place.max(initial=0)) + 1)[place]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        keys.append(mix(sums[begin[1:]] - sums[begin[:-1]] + counts.astype(np.uint64)))
    return keys[0], keys[1]


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``data[i : i + width]`` for every i where it fits."""
    if len(data) < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers(_BASE, len(data)), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(_BASE_INVERSE, len(data))[: len(data) - width + 1])


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers(_BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes in every [start, end)."""
    return mix((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(sums))[starts] + (ends - starts).astype(np.uint64))
