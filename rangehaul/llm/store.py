"""Tables written between steps, in the folder that the cluster shares."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rangehaul.llm.arrays import parts
from rangehaul.session import scratch_path


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, and a lost executor costs no earlier step."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def total_bytes(documents: DataFrame, text: str) -> int:
    """Bytes of all texts; sizes sketches and slices, never what is in the result."""
    return documents.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0


def squeezed(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `text` as compressed bytes (null stays null): texts that only move to where they are cut take less disk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in parts(batches):
            column = pa.array([None if t is None else packer.compress(t.encode()) for t in batch.column(text).to_pylist()], pa.binary())
            yield batch.set_column(batch.schema.names.index(text), text, column)

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {'binary' if f.name == text else f.dataType.simpleString()}" for f in rows.schema))


def unsqueezed(packed: bytes | None) -> bytes | None:
    return None if packed is None else zstandard.decompress(packed)
