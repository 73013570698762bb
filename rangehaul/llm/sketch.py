"""Count-min sketches of all partitions, merged strip by strip.

Each task counts its hashes in sparse strips (counters saturate at two: only "once" or "more" is asked).
Strips of the same place are added up over all tasks, one group per strip, so that neither the driver nor a
task ever holds all sketches. What comes back to the driver is one bit per counter: 128 MB at most, by `MOST_BITS`.
An estimate is never too low, so every value that occurs twice is reported; one that occurs once is reported
if it meets others in all rows. Beyond some 2**30 values the filter lets more and more of them pass:
that costs time in the pass behind it, but changes no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rangehaul.llm.arrays import mix, randoms

ROWS = 2
LEAST_BITS, MOST_BITS, STRIP_BITS = 16, 29, 22
# Hashes that a task holds before it gives their strips out.
FLUSH = 1 << 22


def counter_bits(values: int) -> int:
    """Counters of a row as a power of two: about two for each expected value."""
    return min(MOST_BITS, max(LEAST_BITS, int(values).bit_length() + 1))


def _places(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(hashes ^ randoms(77, ROWS)[row]) >> np.uint64(64 - bits)).astype(np.uint32)


def _strips(held: list[tuple[np.ndarray, ...]], bits: int) -> Iterator[tuple[int, bytes]]:
    """Sorted counter places of each strip, each at most twice, as differences of 16 bits behind the counts of the blocks."""
    strip_bits = min(bits, STRIP_BITS)
    for row in range(ROWS):
        places = np.concatenate([places[row] for places in held])
        places.sort()
        keep = np.ones(len(places), bool)
        keep[2:] = places[2:] != places[:-2]
        places = places[keep]
        strips = places >> np.uint32(strip_bits)
        for part in np.split(places, np.flatnonzero(np.diff(strips)) + 1):
            inside = part & np.uint32((1 << strip_bits) - 1)
            blocks = np.bincount(inside >> np.uint32(16), minlength=max(1, 1 << (strip_bits - 16))).astype(np.uint32)
            gaps = np.diff(inside.astype(np.uint16), prepend=np.uint16(0))
            low, high = gaps.astype(np.uint8), (gaps >> np.uint16(8)).astype(np.uint8)
            yield row << (bits - strip_bits) | int(part[0] >> np.uint32(strip_bits)), zlib.compress(blocks.tobytes() + low.tobytes() + high.tobytes(), 1)


def _merged(bits: int) -> Callable[[pa.Table], pa.Table]:
    strip_bits = min(bits, STRIP_BITS)
    blocks = max(1, 1 << (strip_bits - 16))

    def merge(table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << strip_bits, np.uint8)
        for payload in table.column("counts").to_pylist():
            raw = zlib.decompress(payload)
            sizes = np.frombuffer(raw, np.uint32, blocks)
            halves = np.frombuffer(raw, np.uint8, offset=4 * blocks)
            gaps = halves[: len(halves) // 2].astype(np.uint16) | halves[len(halves) // 2 :].astype(np.uint16) << np.uint16(8)
            places = np.cumsum(gaps, dtype=np.uint16).astype(np.uint32) | np.repeat(np.arange(blocks, dtype=np.uint32) << np.uint32(16), sizes)
            again = np.zeros(len(places), bool)
            again[1:] = places[1:] == places[:-1]
            for part in (places[~again], places[again]):
                counts[part] = np.minimum(counts[part] + 1, 2)
        strip = table.column("strip")[0].as_py()
        return pa.table({"strip": pa.array([strip], pa.int32()), "bits": pa.array([np.packbits(counts > 1).tobytes()], pa.binary())})

    return merge


class Repeated:
    """Tells which hashes are estimated to occur at least twice."""

    def __init__(self, bits: int, marks: np.ndarray):
        self.bits, self.marks = bits, marks

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for row in range(ROWS):
            at = np.flatnonzero(out)
            places = _places(hashes[at], row, self.bits)
            out[at] = self.marks[row][places >> np.uint32(3)] >> (7 - (places & np.uint32(7))).astype(np.uint8) & 1
        return out


def repeated_filter(frame: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], values: int) -> Repeated:
    """Sketch the hashes of all rows and merge the sketches; `values` is about how many hashes there are."""
    bits = counter_bits(values)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        schema = pa.schema([("strip", pa.int32()), ("counts", pa.binary())])

        def flush() -> Iterator[pa.RecordBatch]:
            strips = list(_strips(held, bits))
            held.clear()
            if strips:
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in strips], pa.int32()), pa.array([c for _, c in strips], pa.binary())], schema=schema)

        size = 0
        for batch in batches:
            for part in hashes(batch):
                if len(part):
                    held.append(tuple(_places(part, row, bits) for row in range(ROWS)))
                    size += len(part)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    strips = frame.mapInArrow(sketch, "strip int, counts binary")
    found = strips.groupBy("strip").applyInArrow(_merged(bits), "strip int, bits binary").collect()
    size = (1 << min(bits, STRIP_BITS)) // 8
    marks = np.zeros((ROWS, (1 << bits) // 8), np.uint8)
    flat = marks.reshape(-1)
    for row in found:
        flat[row["strip"] * size : (row["strip"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return Repeated(bits, marks)
