"""Byte context trees over numpy arrays, for models with longest-suffix states.

A tree holds contexts of up to ``depth`` bytes, closed under dropping the
oldest byte.  Node 0 is the empty context.  For each depth a table maps a node
and the next older byte to a deeper node (0: there is none), so the longest
suffix of all positions of a buffer is found with a few array look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PAD = 32  #: byte that stands before a text
STEP = 1 << 20  #: positions looked at in one go


def joined(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts in one buffer, each after ``depth`` pad bytes; their starts and ends."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + depth)
    pad = bytes([PAD]) * depth
    return np.frombuffer(b"".join(x for t in texts for x in (pad, t)), dtype=np.uint8), ends - sizes, ends


def positions(starts: np.ndarray, ends: np.ndarray, total: int) -> np.ndarray:
    """True at the bytes of stretches that are in order and apart."""
    runs = np.empty(2 * len(starts) + 1, dtype=np.int64)
    edges = np.concatenate([[0], ends])
    runs[0:-1:2], runs[1::2], runs[-1] = starts - edges[:-1], ends - starts, total - edges[-1]
    return np.repeat(np.arange(len(runs)) % 2 == 1, runs)


def gram_counts(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of ``depth`` + 1 bytes that end at a byte of a text, as
    big-endian numbers, and how often each comes."""
    buffer, starts, ends = joined(texts, depth)
    if len(buffer) <= depth:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(buffer) - depth
    keys = np.zeros(n, dtype=np.int64)
    for j in range(depth + 1):
        keys <<= 8
        keys |= buffer[j : j + n]
    return np.unique(keys[positions(starts, ends, len(buffer))[depth:]], return_counts=True)


def backward(keys: np.ndarray, depth: int, classes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Big-endian grams -> contexts, newest byte first in base ``width``, and symbols."""
    context = np.zeros(len(keys), dtype=np.int64)
    for d in range(1, depth + 1):
        context = context * width + classes[(keys >> (8 * d)) & 255]
    return context, classes[keys & 255].astype(np.int64)


@dataclass
class ContextTree:
    """``classes``: byte -> symbol; ``children``: one table for each depth;
    ``first``: the number before the first node of each depth."""

    classes: np.ndarray
    width: int
    children: list[np.ndarray]
    first: list[int]
    contexts: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.children)

    @property
    def nodes(self) -> int:
        return 1 + sum(len(c) for c in self.contexts)

    @staticmethod
    def of(contexts: list[np.ndarray], classes: np.ndarray, width: int) -> ContextTree:
        """``contexts``: sorted keys (see :func:`backward`) of depth 1, 2, and so
        on; those whose suffix is absent are left out."""
        children, first, kept, above = [], [], [], np.zeros(1, dtype=np.int64)
        count = 1
        for d, keys in enumerate(contexts):
            keys = np.asarray(keys, dtype=np.int64)
            if d:
                at = np.searchsorted(above, keys // width)
                parent = np.where((at < len(above)) & (len(above) > 0), at, 0)
                here = (above[parent] == keys // width) if len(above) else np.zeros(len(keys), bool)
                keys, rows = keys[here], parent[here] + 1
            else:
                rows = np.zeros(len(keys), dtype=np.int64)
            table = np.zeros((len(above) + 1 if d else 1, width), dtype=np.int32)
            table[rows, keys % width] = np.arange(1, len(keys) + 1)
            children.append(table.ravel())
            first.append(count - 1)
            kept.append(keys)
            count += len(keys)
            above = keys
        return ContextTree(classes, width, children, first, kept)

    def walk(self, symbols: np.ndarray) -> np.ndarray:
        """Node of the longest suffix before each position from ``depth`` on."""
        n = len(symbols) - self.depth
        node, at = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
        for d, (table, first) in enumerate(zip(self.children, self.first), 1):
            at = table[at * np.int32(self.width) + symbols[self.depth - d : self.depth - d + n]]
            node = np.where(at > 0, at + np.int32(first), node)
        return node

    def sums(self, texts: list[bytes], table: np.ndarray) -> np.ndarray:
        """For each text the sum over its bytes of ``table[node, symbol]``."""
        return self.segment_sums(*joined(texts, self.depth), table)

    def segment_sums(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Sums over the given stretches of a buffer, in order and apart.

        ``table``: nodes x symbols x columns.  Works in steps of bounded size,
        whatever the stretches' lengths.
        """
        flat = table.reshape(self.nodes * self.width, -1)
        out = np.zeros((len(starts), flat.shape[1]))
        columns = [np.ascontiguousarray(flat[:, 0])] if flat.shape[1] == 1 else None
        if not len(starts):
            return out
        symbols = self.classes[buffer].astype(np.int32)
        inside = positions(starts, ends, len(buffer))
        for lo in range(self.depth, len(buffer), STEP):
            hi = min(lo + STEP, len(buffer))
            part = symbols[lo - self.depth : hi]
            at = self.walk(part) * np.int32(self.width) + part[self.depth :]
            a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi, "left")
            if a < b:
                cuts, stops = np.clip(starts[a:b], lo, hi), np.clip(ends[a:b], lo, hi)
                real = stops > cuts
                if columns:  # one column: sums of a flat array are much faster
                    value = np.zeros(hi - lo + 1)
                    np.multiply(columns[0][at], inside[lo:hi], out=value[:-1])
                    out[a:b, 0] += np.add.reduceat(value, cuts - lo) * real
                else:
                    value = np.concatenate([flat[at] * inside[lo:hi, None], np.zeros((1, flat.shape[1]), flat.dtype)])
                    out[a:b] += np.add.reduceat(value, cuts - lo, axis=0, dtype=np.float64) * real[:, None]
        return out
