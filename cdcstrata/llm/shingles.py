"""Word shingles of whole texts as sorted 64-bit hashes, in numpy, a batch of texts at a time.

Words are runs without white space, in lower case; a shingle is five words in a row. A text of one to four words has one
shingle, all its words. A null, empty or blank text has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
_WEIGHTS = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 for k in range(WORDS)], np.uint64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser over hashes."""
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def portions(texts: pa.Array, limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, first = np.cumsum(sizes), 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, last
        first = last


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a batch in a row, and where each text's words begin and end."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    lengths = pc.list_value_length(lists).to_numpy()
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    codes = coded.indices.to_numpy()
    text_of = np.repeat(np.arange(len(texts)), lengths)
    if "" in words:  # at the ends of a text
        ink = codes != words.index("")
        codes, text_of = codes[ink], text_of[ink]
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
    return known[codes] if len(known) else np.empty(0, np.uint64), bounds


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    if not len(texts):
        return []
    hashes, bounds = _word_hashes(texts)
    n = len(hashes)
    windows = np.zeros(max(0, n - WORDS + 1), np.uint64)
    for k in range(WORDS):
        windows += hashes[k : k + len(windows)] * _WEIGHTS[k]
    windows = mixed(windows)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(windows[a : b - WORDS + 1]))
        elif b > a:
            whole = (hashes[a:b] * _WEIGHTS[: b - a]).sum(dtype=np.uint64)
            out.append(mixed(np.array([whole], np.uint64), salt=b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out
