"""Runs of bytes of one kind in a text, and their distinct values, without a loop over words.

Places are 32-bit: Arrow hands over texts of less than 2 GB, and blocks are as long as one text
at most.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are joined and cut into runs in blocks of about so many bytes; a longer text is a
# block of its own. What a block needs beside its bytes is some 30 times as much.
BLOCK_BYTES = 8 << 20


def kinds(default: int, **of: str | bytes) -> np.ndarray:
    """A table byte -> kind. Keywords `k<n>` name the bytes of kind n; the rest are `default`."""
    table = np.full(256, default, np.uint8)
    for name, members in of.items():
        members = members.encode("latin-1") if isinstance(members, str) else members
        table[list(members)] = int(name[1:])
    return table


def runs(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, kind) of the longest runs of one kind. Kind 0 makes no runs."""
    kind = table[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(kind[1:] != kind[:-1]).astype(np.int32) + np.int32(1)
    starts = np.concatenate([np.zeros(min(len(kind), 1), np.int32), edges])
    ends = np.append(edges, np.int32(len(kind)))[: len(starts)]
    of = kind[starts]
    shown = of > 0
    return starts[shown], ends[shown], of[shown]


def coded(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The number of each run among the distinct runs, and these. Runs are in order and apart."""
    if not len(starts):
        return np.zeros(0, np.int32), []
    # Runs and the gaps between them alternate, so that one list of offsets bounds both.
    offsets = np.empty(2 * len(starts), np.int32)
    offsets[0::2], offsets[1::2] = starts, ends
    pieces = pa.BinaryArray.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).dictionary_encode()
    codes = pieces.indices.to_numpy(zero_copy_only=False)[::2]
    is_run = np.zeros(len(pieces.dictionary), bool)
    is_run[codes] = True
    values = pieces.dictionary.filter(pa.array(is_run)).to_pylist()
    return (np.cumsum(is_run, dtype=np.int32) - np.int32(1))[codes], values


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of stretches of a text column of about BLOCK_BYTES each."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes, dtype=np.int64) // BLOCK_BYTES
    bounds = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(column)]
    yield from ((a, b - a) for a, b in zip(bounds, bounds[1:]) if b > a)


def blocks(texts: list[bytes]) -> Iterator[list[int]]:
    """The numbers of the texts, in order, in blocks of about BLOCK_BYTES."""
    block, held = [], 0
    for number, text in enumerate(texts):
        if block and held + len(text) > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append(number)
        held += len(text)
    if block:
        yield block
