"""Vector code over the texts of Arrow batches: rows cut by bytes, runs of characters, their words.

All functions take whole texts as UTF-8 bytes; a row is never cut. What a task holds
at once is a piece of ``limit`` bytes of text, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once.
PIECE_BYTES = 4 << 20


def byte_table(chars: str) -> np.ndarray:
    """A truth table over bytes for the given ASCII characters."""
    table = np.zeros(256, bool)
    table[list(chars.encode("ascii"))] = True
    return table


#: ASCII white space, the separator of the word contracts.
SPACES = byte_table(" \t\n\x0b\f\r")


def cut_by_bytes(batch: pa.RecordBatch, column: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in pieces of at most ``limit`` bytes in ``column`` (a longer row alone)."""
    upto = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, base + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows of a binary column without nulls, and the rows' offsets in them."""
    wide = column.cast(pa.large_binary())
    _, places, data = wide.buffers()
    offsets = np.frombuffer(places, np.int64, len(wide) + 1, wide.offset * 8) if len(wide) else np.zeros(1, np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many places of each row the mask marks."""
    out = np.zeros(len(offsets) - 1, np.int64)
    filled = offsets[1:] > offsets[:-1]
    if filled.any():
        out[filled] = np.add.reduceat(mask[:offsets[-1]], offsets[:-1][filled], dtype=np.int64)
    return out


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of marked bytes; no run goes over the end of a row."""
    filled = offsets[1:] > offsets[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = offsets[:-1][filled], offsets[1:][filled] - 1
    first[begins], last[ends] = inside[begins], inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """The byte strings from each start to its end (ordered, not overlapping)."""
    if not len(starts):
        return pa.array([], pa.binary())
    places = np.empty(2 * len(starts), np.int32)
    places[0::2], places[1::2] = starts, ends
    with_gaps = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])
    return with_gaps.take(pa.array(np.arange(0, len(places) - 1, 2, dtype=np.int32)))


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the distinct words by number."""
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def byte_list(column: pa.BinaryArray) -> list[bytes]:
    """The values of a binary array that begins at offset 0 and has no nulls."""
    _, places, data = column.buffers()
    ends = np.frombuffer(places, np.int32, len(column) + 1).tolist() if len(column) else []
    whole = data.to_pybytes() if data is not None else b""
    return [whole[a:b] for a, b in zip(ends, ends[1:], strict=False)]
