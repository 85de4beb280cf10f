"""Hashes of the words of many texts at once, for tasks that work on Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at a time; bounds the memory a task needs besides one hash per word.
SEGMENT = 1 << 20

_random = np.random.default_rng(20240229)
_LETTER = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def lower_table(separators: bytes) -> np.ndarray:
    """Byte -> byte with A-Z lower-cased; separators are 0, and so is the zero byte."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


#: Words between ASCII white space; the zero byte gets a code of its own that no text holds (0xFF is not UTF-8).
SPACED = lower_table(b" \t\n\x0b\x0c\r")
SPACED[0] = 0xFF
#: Words of letters and digits; everything outside ASCII counts as a letter.
LETTERS = lower_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n, parts = len(column), column.buffers()
    offsets = np.frombuffer(parts[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(parts[2], np.uint8) if parts[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, text number) of every word, in order. Words end at separators and at the ends of texts."""
    hashes, starts, at, n = [], [], 0, len(data)
    while at < n:
        end = _cut(data, offsets, table, at, n)
        codes = table[data[at:end]]
        inside = codes != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        begins[edges] = inside[edges]
        where = np.flatnonzero(begins)
        if len(where):
            first = where[0]
            sizes = np.diff(np.append(where, len(codes)))
            place = np.arange(first, len(codes)) - np.repeat(where, sizes)
            powers = np.full(int(place.max()) + 1, _STEP, np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers, dtype=np.uint64)
            letters = np.where(inside[first:], _LETTER[codes[first:]], np.uint64(0))
            hashes.append(mix(np.add.reduceat(letters * powers[place], where - first)))
            starts.append(where + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    where = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(offsets, where, side="right") - 1


def _cut(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, at: int, n: int) -> int:
    """Where the segment that begins at ``at`` ends: between texts or words."""
    if n - at <= SEGMENT:
        return n
    end = int(offsets[np.searchsorted(offsets, at + SEGMENT, side="right") - 1])
    if end > at:
        return end
    size = SEGMENT
    while at + size < n:  # inside a text longer than a segment
        gaps = np.flatnonzero(table[data[at : at + size]] == 0)
        if len(gaps):
            return at + int(gaps[-1]) + 1
        size *= 2
    return n


def window_hashes(words: np.ndarray, texts: np.ndarray, places: tuple[int, ...], salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of the words at ``places`` of every window that lies in one text."""
    span = places[-1] + 1
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, np.uint64(salt), np.uint64)
    for k, j in enumerate(places):
        total += words[j : j + n] * (_LETTER[(k + 1) % 256] ^ np.uint64(salt << 1))
    at = np.flatnonzero(texts[:n] == texts[span - 1 :])
    return mix(total[at]), at


def slices(batches, column: str, limit: int = 4 << 20):
    """Pieces of record batches with about ``limit`` bytes of ``column``; a longer text is a piece of its own."""
    for batch in batches:
        data, offsets = buffers(batch.column(column))
        del data
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def shingles(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the distinct word shingles of each text, ordered by text and hash.

    Words stand between ASCII white space, A-Z lower-cased. A text with fewer words than ``width`` has one shingle of them
    all, and none without words.
    """
    data, offsets = buffers(column)
    words, texts = word_hashes(data, offsets, SPACED)
    hashes, at = window_hashes(words, texts, tuple(range(width)))
    owner = texts[at]
    first = np.searchsorted(texts, np.arange(len(offsets)))
    counts = np.diff(first)
    more, owners = [hashes], [owner]
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        total = np.full(len(short), np.uint64(n), np.uint64)
        for j in range(n):
            total += words[first[short] + j] * _LETTER[128 + j]
        more.append(mix(total))
        owners.append(short)
    hashes, owner = np.concatenate(more), np.concatenate(owners)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[keep], owner[keep]
