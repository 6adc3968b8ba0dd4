"""Anchors of fixed-length strings in texts, chosen by content alone, for whole batches at once.

Every string of ``length`` bytes has one anchor: the k-gram in it with the least hash, the first
of equal ones. Equal strings have their anchors at the same place, and neighbouring strings mostly
share one, so a text has about one anchor for (length - k) / 2 bytes.
"""

from __future__ import annotations

import numpy as np

from goldrec.llm.shingles import BYTES, U, mix

GRAM = 24


def _run_hashes(data: np.ndarray, spans: tuple[int, ...]) -> dict[int, np.ndarray]:
    """For each span a hash of the bytes from every place on; short ones at the end are left out."""
    powers = {1: BYTES[data]}
    size = 1
    while size * 2 <= max(spans):
        h = powers[size]
        powers[size * 2] = h[:-size] * U((0xD6E8FEB86659FD93 + 2 * size) | 1) + h[size:] if len(h) > size else h[:0]
        size *= 2
    out = {}
    for span in spans:
        rest, whole, done = span, None, 0
        while rest:
            part = 1 << (rest.bit_length() - 1)
            h = powers[part][done:]
            whole = h if whole is None else whole[:len(h)] * U(0x9E3779B97F4A7C15) + h[:len(whole)]
            done, rest = done + part, rest - part
        out[span] = whole[:max(0, len(data) - span + 1)]
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, in doubling steps."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    more = width - size
    return np.minimum(x[:len(x) - more], x[more:]) if more else x


class Strings:
    """All strings of ``length`` bytes in a run of texts that lie one behind another.

    start: their places; text: the number of the text; anchor: the place of their anchor.
    ``h``: the hash of an anchor's k-gram; ``half``: two hashes that tell a string.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.length = length
        ends = offsets[1:]
        usable = np.maximum(0, np.diff(offsets) - length + 1)
        self.text = np.repeat(np.arange(len(usable)), usable)
        self.start = np.arange(len(self.text)) + np.repeat(offsets[:-1] - (np.cumsum(usable) - usable), usable)
        if not len(self.start):
            self.anchor = self.start
            return
        half = length // 2 + 14
        hashes = _run_hashes(data, (GRAM, half))
        gram = mix(hashes[GRAM])
        bits = U(max(1, int(len(data)).bit_length()))
        ranked = (gram >> bits << bits) | np.arange(len(gram), dtype=U)
        least = _sliding_min(ranked, length - GRAM + 1)
        self.anchor = (least[self.start] & ((U(1) << bits) - U(1))).astype(np.int64)
        self.gram, self.half, self.back = gram, hashes[half], length - half

    def keys(self, at: np.ndarray) -> np.ndarray:
        """A hash of the string at each place."""
        return mix(self.half[at] * U(0xC2B2AE3D27D4EB4F) + mix(self.half[at + self.back]))

    def runs(self):
        """first and last string (indexes) of each run that shares an anchor, its h and a hash c of all the run covers."""
        if not len(self.start):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, U), np.zeros(0, U)
        fresh = np.ones(len(self.start), bool)
        fresh[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.text[1:] != self.text[:-1])
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(fresh)) - 1
        a, b, anchor = self.start[first], self.start[last], self.anchor[first]
        c = self.keys(a) * U(0x9E3779B97F4A7C15) + self.keys(b) * U(0xD6E8FEB86659FD93) + (anchor - a).astype(U) * U(1 << 20) + (b - a).astype(U)
        return first, last, self.gram[anchor], mix(c)
