"""Hashes of word shingles, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
#: Bytes looked at together; about fifty bytes of memory are needed for each.
STEP = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def parts(batches, rows: int = 1_000):
    """Arrow batches in slices, so that what is made of them at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _byte_table(fold: bool) -> np.ndarray:
    code = np.arange(256, dtype=U)
    if fold:
        code[65:91] += U(32)
    return mix(code + U(1))


BYTES, FOLDED = _byte_table(False), _byte_table(True)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after another, and where each begins (and the last ends). Nulls are empty."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def _cuts(data: np.ndarray) -> list[int]:
    """Where to cut the bytes into parts of about STEP: before a blank, so that no word is cut."""
    cuts, at = [0], STEP
    while at < len(data):
        blank = np.flatnonzero(BLANK[data[at:at + STEP]])
        if len(blank):
            cuts.append(at + int(blank[0]))
            at = cuts[-1] + STEP
        else:
            at += STEP
    return [*cuts, len(data)]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word with A-Z lower-cased, and where each text's words begin in that list."""
    all_starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    cuts = _cuts(data)
    for at, end in zip(cuts[:-1], cuts[1:]):
        part = data[at:end]
        word = ~BLANK[part]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        inner = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)] - at
        begins[inner] = word[inner]  # words don't go on from one text to the next
        starts = np.flatnonzero(begins)
        if not len(starts):
            continue
        lengths = np.diff(np.append(starts, len(part)))  # with the blanks behind
        place = np.arange(starts[0], len(part)) - np.repeat(starts, lengths)
        # a factor of its own for each place: with powers of one number, some long words would always collide
        factors = mix(np.arange(int(place.max()) + 1, dtype=U) + U(1)) | U(1)
        value = np.where(word[starts[0]:], FOLDED[part[starts[0]:]] * factors[place], U(0))
        hashes.append(mix(np.add.reduceat(value, starts - starts[0])))
        all_starts.append(starts + at)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(all_starts), offsets)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; of fewer words, all of them make one."""
    words, first = word_hashes(*buffers(texts))
    hashes = np.zeros(0, U)
    if len(words) >= size:
        n = len(words) - size + 1
        hashes = words[:n].copy()
        for i in range(1, size):
            hashes = hashes * _ODD + words[i:n + i]
        hashes = mix(hashes)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(hashes[a:b - size + 1]))
        elif b > a:
            one = words[a:a + 1].copy()
            for w in words[a + 1:b]:
                one = one * _ODD + w
            out.append(mix(one + U(int(b - a))))
        else:
            out.append(np.zeros(0, U))
    return out
