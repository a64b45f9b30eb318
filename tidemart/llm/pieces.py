"""The pieces that many texts are made of, coded together."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa


class Pieces:
    """Runs of bytes between spaces in some texts, after each byte is replaced by that of ``table``.

    ``row`` is the text of each piece, in order, and ``code`` its place among the ``distinct`` ones; ``counts`` is how
    many pieces each text has. ``inner`` tells, of all bytes, where else a piece ends and the next one begins.
    """

    def __init__(self, texts: pa.LargeBinaryArray, table: bytes, inner: Callable[[np.ndarray], np.ndarray] | None = None):
        offsets = np.frombuffer(texts.buffers()[1], "i8")[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = bytes(data[offsets[0] : offsets[-1]]) if data else b""
        raw, offsets = np.frombuffer(raw.translate(table), "u1"), offsets - offsets[0]
        inside = raw != 0x20
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        # a piece ends with its text
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        if inner:
            cuts = np.concatenate((cuts, inner(raw)))
        first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
        at = np.flatnonzero(first)
        ends = np.zeros(len(at) + 1, "i8")
        np.cumsum(np.flatnonzero(last) + 1 - at, out=ends[1:])
        del first, last
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(raw[inside])]
        coded = pa.Array.from_buffers(pa.large_binary(), len(at), buffers).dictionary_encode()
        # how many pieces begin before each text's end
        self.counts = np.diff(np.searchsorted(at, offsets))
        self.code, self.distinct = coded.indices.to_numpy(), coded.dictionary

    @cached_property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def firsts(self, size: int | None = None) -> list[bytes]:
        """The distinct pieces, or their first bytes."""
        if not len(self.distinct):
            return []
        offsets = np.frombuffer(self.distinct.buffers()[1], "i8")[: len(self.distinct) + 1]
        data = bytes(self.distinct.buffers()[2])
        ends = offsets[1:] if size is None else np.minimum(offsets[1:], offsets[:-1] + size)
        return [data[a:b] for a, b in zip(offsets[:-1].tolist(), ends.tolist(), strict=True)]
