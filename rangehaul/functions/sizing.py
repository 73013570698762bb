"""How many ranges, how many files, how many rows per fetch: column expressions over table sizes."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, functions as F

MIB = 1 << 20
GIB = 1 << 30


class _Positive:
    """Limits are positive whole numbers; an absent one is None."""

    def __post_init__(self) -> None:
        for field in fields(self):
            value = getattr(self, field.name)
            if value is None and field.default is None:
                continue
            if isinstance(value, bool) or not isinstance(value, int) or value < 1:
                raise ValueError(f"{field.name} must be a positive whole number, not {value!r}")


@dataclass(frozen=True)
class PartitionLimits(_Positive):
    """Limits of one Spark read."""

    max_connections: int = 8
    task_slots: int = 2
    oversubscription: int = 1
    target_bytes: int = 32 * MIB


@dataclass(frozen=True)
class ChunkLimits(_Positive):
    """Limits of durable chunks. A `target_bytes` makes the choice manual."""

    max_workers: int = 4
    max_connections: int = 4
    max_chunks: int = 128
    target_bytes: int | None = None
    # Fixed values of the automatic choice.
    single_below_bytes: int = 128 * MIB
    preferred_bytes: int = 256 * MIB
    smallest_bytes: int = 32 * MIB
    largest_bytes: int = 4 * GIB
    smallest_rows: int = 100_000
    largest_rows: int = 5_000_000


@dataclass(frozen=True)
class FetchLimits(_Positive):
    """Rows per fetch follow the row width. `rows` makes the choice manual."""

    batch_bytes: int = 16 * MIB
    min_rows: int = 1_000
    max_rows: int = 100_000
    rows: int | None = None


def units_of(amount: Column, unit: Column | int) -> Column:
    """How many whole units hold the amount: ceil(amount / unit) in exact integer arithmetic."""
    unit = F.lit(unit).cast("bigint") if isinstance(unit, int) else unit.cast("bigint")
    return F.call_function("div", amount.cast("bigint") + unit - F.lit(1), unit)


def _number(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _non_negative(value: Column) -> Column:
    return F.greatest(_number(0), F.coalesce(value.cast("bigint"), _number(0)))


def partition_count(size_bytes: Column, limits: PartitionLimits = PartitionLimits()) -> Column:
    """Ranges of one Spark read: bounded by connections, by task slots and by bytes; at least one."""
    budget = min(limits.max_connections, limits.task_slots * limits.oversubscription)
    return F.greatest(_number(1), F.least(_number(budget), units_of(_non_negative(size_bytes), limits.target_bytes)))


def cluster_limits(slots: int, connections: int | None = None, waves: int = 4, target_bytes: int = 256 * MIB) -> PartitionLimits:
    """Limits of a read on a cluster with so many task slots: up to `waves` ranges a slot, and never more than the source allows connections."""
    return PartitionLimits(max_connections=connections or slots * waves, task_slots=slots, oversubscription=waves, target_bytes=target_bytes)


def planned_ranges(size_bytes: int, limits: PartitionLimits) -> int:
    """`partition_count` for one size that the driver already holds."""
    budget = min(limits.max_connections, limits.task_slots * limits.oversubscription)
    return max(1, min(budget, -(-max(0, size_bytes) // limits.target_bytes)))


def chunk_count(size_rows: Column, size_bytes: Column, limits: ChunkLimits = ChunkLimits()) -> Column:
    """Durable chunks. A small table stays whole; a large one gets chunks big enough to be
    worth a connection, small enough to be repeated, and about two per connection."""
    rows, size = _non_negative(size_rows), _non_negative(size_bytes)
    cap = _number(limits.max_chunks)
    if limits.target_bytes is not None:
        return F.greatest(_number(1), F.least(cap, units_of(size, limits.target_bytes)))
    useful = F.greatest(
        _number(1),
        F.least(cap, units_of(size, limits.smallest_bytes), units_of(rows, limits.smallest_rows)),
    )
    connections = max(1, min(limits.max_workers, limits.max_connections))
    wanted = F.greatest(
        units_of(size, limits.largest_bytes),
        units_of(rows, limits.largest_rows),
        units_of(size, limits.preferred_bytes),
        F.least(_number(2 * connections), useful),
    )
    chosen = F.greatest(_number(1), F.least(useful, wanted))
    return F.when((size <= limits.single_below_bytes) | (rows == 0), _number(1)).otherwise(chosen)


def chunk_bytes(size_bytes: Column, chunks: Column, limits: ChunkLimits = ChunkLimits()) -> Column:
    """The byte target that belongs to a chunk count."""
    if limits.target_bytes is not None:
        return _number(limits.target_bytes)
    return F.greatest(_number(1), units_of(_non_negative(size_bytes), chunks))


def fetch_rows(size_rows: Column, size_bytes: Column, chunks: Column, limits: FetchLimits = FetchLimits()) -> Column:
    """Rows per fetch: a batch of bytes divided by the row width, never more than one chunk holds."""
    if limits.rows is not None:
        return _number(limits.rows)
    rows, size = _non_negative(size_rows), _non_negative(size_bytes)
    some_rows = F.greatest(_number(1), rows)
    width = F.greatest(_number(1), units_of(size, some_rows))
    by_width = F.call_function("div", _number(limits.batch_bytes), width)
    batch = F.greatest(_number(limits.min_rows), F.least(_number(limits.max_rows), by_width))
    per_chunk = F.greatest(_number(1), units_of(rows, F.greatest(_number(1), chunks)))
    return F.when(rows == 0, _number(limits.min_rows)).otherwise(F.least(batch, per_chunk))


def file_count(source_bytes: Column, target_bytes: int, compression_ratio: float = 0.33) -> Column:
    """Output files for an estimated source size."""
    output = F.greatest(_number(1), F.ceil(_non_negative(source_bytes) * F.lit(compression_ratio)).cast("bigint"))
    return F.greatest(_number(1), units_of(output, target_bytes))
