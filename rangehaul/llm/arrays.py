"""Words and windows of whole text columns as NumPy arrays, one Arrow batch at a time.

A chunk is a run of rows whose texts together hold about `CHUNK_BYTES`; a longer text is a chunk of its
own, so that no text is ever cut. Hashes are polynomials modulo 2**64 over random byte values,
mixed at the end; two of them with different tables identify a window (96 bits and more).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
SEGMENT_BYTES = 1 << 18

# ASCII white space: tab to carriage return, and space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64, copy=True)
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        return z


def randoms(seed: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed) * np.uint64(0xD1342543DE82EF95))


class Polynomial:
    """Hashes of byte ranges: the sum of table[byte] * base**position, made independent of the place."""

    def __init__(self, seed: int):
        self.table = randoms(seed, 256)
        self.base = int(randoms(seed + 1000, 1)[0]) | 1
        self.powers = self.inverses = np.ones(1, np.uint64)

    def reserve(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, SEGMENT_BYTES + 1024)
            for name, base in (("powers", self.base), ("inverses", pow(self.base, -1, 1 << 64))):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end]; starts and ends ascend. Worked off in segments, so memory stays small."""
        out = np.empty(len(starts), np.uint64)
        first = 0
        while first < len(starts):
            low = int(starts[first])
            last = max(first + 1, int(np.searchsorted(ends, low + SEGMENT_BYTES, "right")))
            high = int(ends[last - 1])
            self.reserve(high - low + 1)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(self.table[data[low:high]] * self.powers[: high - low], out=sums[1:])
            at = starts[first:last] - low
            out[first:last] = (sums[ends[first:last] - low] - sums[at]) * self.inverses[at]
            first = last
        return mix(out)


class Words(NamedTuple):
    """Words of a chunk in text order: row of each word, its byte range, and two hashes."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    second: np.ndarray


class Chunk(NamedTuple):
    """Consecutive rows of a batch: the row range, their bytes, and where each row's text begins."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray


PART_ROWS = 512


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in smaller batches, so that what is made of them at a time stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(low, PART_ROWS)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of a string column; a null text is empty. The column is converted a part at a time."""
    for base in range(0, len(column), PART_ROWS):
        part = pc.fill_null(column.slice(base, PART_ROWS).cast(pa.large_string()), "")
        _, offset_buffer, data_buffer = part.buffers()
        offsets = np.frombuffer(offset_buffer, np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
        low = 0
        while low < len(part):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
            yield Chunk(base + low, base + high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            low = high


def row_of(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, places, "right") - 1


_FIRST, _SECOND = Polynomial(1), Polynomial(2)


def word_bounds(chunk: Chunk, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the maximal runs of bytes that are not `space`."""
    data = chunk.data
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = space[data]
    edge = chunk.offsets[:-1]
    edge = edge[edge < len(data)]
    opens = np.empty(len(data), bool)
    opens[0] = True
    opens[1:] = space[:-1]
    opens[edge] = True
    closes = np.empty(len(data), bool)
    closes[-1] = True
    closes[:-1] = space[1:]
    closes[edge[edge > 0] - 1] = True
    starts = np.flatnonzero(opens & ~space)
    ends = np.flatnonzero(closes & ~space) + 1
    return row_of(chunk.offsets, starts), starts, ends


def words(chunk: Chunk, lower: bool = False) -> Words:
    """Words at ASCII white space, as UTF-8 text splits, with hashes."""
    row, starts, ends = word_bounds(chunk)
    data = LOWER[chunk.data] if lower else chunk.data
    return Words(row, starts, ends, _FIRST.ranges(data, starts, ends), _SECOND.ranges(data, starts, ends))


def windows(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of each run of `width` hashes; a run that reaches over the end has none."""
    count = max(0, len(hashes) - width + 1)
    total = np.zeros(count, np.uint64)
    for j, factor in enumerate(randoms(seed, width) | np.uint64(1)):
        total += hashes[j : j + count] * factor
    return mix(total)


def same_row(rows: np.ndarray, width: int) -> np.ndarray:
    """Whether the run of `width` entries that begins here lies in one row."""
    count = max(0, len(rows) - width + 1)
    return rows[:count] == rows[width - 1 : width - 1 + count]


def heads(*columns: np.ndarray) -> np.ndarray:
    """Marks the first row of each run of equal rows."""
    head = np.ones(len(columns[0]), bool)
    if len(head):
        head[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return head


def pack(*columns: np.ndarray) -> bytes:
    """Integer columns of equal length: least value, then as many byte planes as the widest difference from it needs."""
    parts = [len(columns[0]).to_bytes(8, "little")]
    for column in columns:
        values = column.astype(np.uint64)  # two's complement: differences are right for signed values too
        least = values[np.argmin(column)] if len(column) else np.uint64(0)
        values = values - least
        planes = (int(values.max()).bit_length() + 7) // 8 if len(column) else 0
        parts += [int(least).to_bytes(8, "little"), bytes([planes]), values.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()]
    return b"".join(parts)


def unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    count, at, out = int.from_bytes(payload[:8], "little"), 8, []
    for kind in kinds:
        least, planes = int.from_bytes(payload[at : at + 8], "little"), payload[at + 8]
        values = np.zeros((count, 8), np.uint8)
        values[:, :planes] = np.frombuffer(payload, np.uint8, planes * count, at + 9).reshape(planes, count).T
        out.append((values.view(np.uint64).reshape(-1) + np.uint64(least)).astype(kind))
        at += 9 + planes * count
    return out


def differences(ascending: np.ndarray) -> np.ndarray:
    """Gaps of an ascending column; a first value of 0 stands for the base, which goes apart."""
    return np.diff(ascending, prepend=ascending[:1])


def lists(values: np.ndarray, keys: tuple[np.ndarray, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """Group runs of equal keys: the key columns of each run, and list offsets into `values`."""
    head = np.flatnonzero(heads(*keys))
    return [k[head] for k in keys], np.append(head, len(values)).astype(np.int32)
