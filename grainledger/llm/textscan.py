"""Vectorised reading of text columns inside Arrow tasks: bytes, words, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once; numpy's working arrays are some 30 times this.
SLICE_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Bytes of words: ASCII letters and digits, and every byte of a character beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows. A null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `most` bytes of text; a longer single text is a run of its own."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = np.asarray(pc.binary_length(column.fill_null("")))
    at = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(at):
        before = at[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(at, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes of a kind; runs end where rows end."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = kind[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    inner = offsets[1:-1]
    edge[inner[inner < len(data)]] = True
    cut = np.flatnonzero(edge)
    starts = cut[inside[cut]]
    ends = np.append(cut, len(data))[1:][inside[cut]]
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            up, down = np.full(size, _BASE), np.full(size, inverse)
            up[0] = down[0] = 1
            _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes that does not depend on where the span is."""
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
