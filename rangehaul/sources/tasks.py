"""Code that runs inside tasks: Parquet footers and row groups as Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

# Sent to the executors by value, so that they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOOTER = pa.schema([("path", pa.string()), ("column", pa.string()), ("type", pa.string()), ("num_rows", pa.int64())])
GROUP = pa.schema([("path", pa.string()), ("row_group", pa.int32()), ("num_rows", pa.int64()), ("bytes", pa.int64())])


def open_parquet(path: str):
    """A Parquet file on any file system pyarrow knows."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    plain = path.startswith("file:/") and not path.startswith("file://")
    filesystem, inner = pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if plain else path)
    return pq.ParquetFile(inner, filesystem=filesystem)


def read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per file and column."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_parquet(path) as parquet:
                fields, rows = list(parquet.schema_arrow), parquet.metadata.num_rows
            yield pa.RecordBatch.from_pydict(
                {
                    "path": [path] * len(fields),
                    "column": [f.name for f in fields],
                    "type": [str(f.type) for f in fields],
                    "num_rows": [rows] * len(fields),
                },
                schema=FOOTER,
            )


def counts_reader(columns: list[str] | None):
    """Adds rows and decoded bytes of the chosen columns to each file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes = [], []
            for path in batch.column("path").to_pylist():
                with open_parquet(path) as parquet:
                    footer = parquet.metadata
                    parts = [footer.row_group(i).column(k) for i in range(footer.num_row_groups) for k in range(footer.num_columns)]
                rows.append(footer.num_rows)
                sizes.append(sum(p.total_uncompressed_size for p in parts if columns is None or p.path_in_schema.split(".")[0] in columns))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.int64()), pa.array(sizes, pa.int64())], names=[*batch.schema.names, "rows", "bytes"])

    return read


def read_row_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per file and row group."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_parquet(path) as parquet:
                groups = [parquet.metadata.row_group(i) for i in range(parquet.metadata.num_row_groups)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": [path] * len(groups),
                        "row_group": list(range(len(groups))),
                        "num_rows": [g.num_rows for g in groups],
                        "bytes": [g.total_byte_size for g in groups],
                    },
                    schema=GROUP,
                )


def row_group_reader(arrow: pa.Schema, batch_rows: int):
    """Reader of control rows (path, row_group) for `mapInArrow`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, group in zip(batch.column("path").to_pylist(), batch.column("row_group").to_pylist()):
                with open_parquet(path) as parquet:
                    for piece in parquet.iter_batches(batch_rows, row_groups=[group], columns=arrow.names):
                        columns = [piece.column(f.name).cast(f.type) for f in arrow]
                        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return read


def zone_reader(column: str, kind: pa.DataType):
    """One row per file and row group with the bounds of a top-level column, for `mapInArrow`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "row_group", "num_rows", "bytes", "nulls", "low", "high"]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_parquet(path) as parquet:
                    footer = parquet.metadata
                    groups = [footer.row_group(g) for g in range(footer.num_row_groups)]
                    bounds = [column_bounds(group, column) for group in groups]
                    rows, sizes = [g.num_rows for g in groups], [g.total_byte_size for g in groups]
                arrays = [
                    pa.array([path] * len(groups), pa.string()), pa.array(range(len(groups)), pa.int32()), pa.array(rows, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array([b[2] for b in bounds], pa.int64()),
                    typed_bounds([b[0] for b in bounds], kind), typed_bounds([b[1] for b in bounds], kind),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return read


def column_bounds(group, column: str) -> tuple:
    """(low, high, nulls) of a column in a row group; None for what the footer does not say."""
    for k in range(group.num_columns):
        part = group.column(k)
        if part.path_in_schema == column:
            stats = part.statistics
            if stats is None:
                return None, None, None
            nulls = stats.null_count if stats.has_null_count else None
            return (stats.min, stats.max, nulls) if stats.has_min_max else (None, None, nulls)
    return None, None, None


def typed_bounds(values: list, kind: pa.DataType) -> pa.Array:
    """Bounds as the key's type. Bytes and NaN bound nothing, and neither do values of a type that does not convert."""
    sound = [None if isinstance(v, bytes) or v != v else v for v in values]
    try:
        return pa.array(sound).cast(kind) if any(v is not None for v in sound) else pa.nulls(len(sound), kind)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, pa.ArrowTypeError):
        return pa.nulls(len(sound), kind)


def may_hold(group, filters) -> bool:
    """Whether a row group may hold a row that meets all filters (column, operator, value), by its statistics."""
    for column, operator, value in filters:
        low, high, nulls = column_bounds(group, column)
        if operator == "null":
            if nulls == 0:
                return False
            continue
        if nulls is not None and nulls == group.num_rows:
            return False
        if operator == "notnull" or low is None or high is None:
            continue
        try:
            out = {"=": value < low or value > high, "<": low >= value, "<=": low > value, ">": high <= value, ">=": high < value}[operator]
        except TypeError:
            continue
        # Statistics of floating columns leave NaN out, and Spark takes NaN for the greatest number.
        if out and not (isinstance(low, float) and operator in (">", ">=", "=")):
            return False
    return True


def zone_batches(predicate: str, options: dict, schema: pa.Schema, filters=()) -> Iterator[pa.RecordBatch]:
    """The rows of one range: its row groups come from its part of the zone table, rows outside the range are left out."""
    import pyarrow.compute as pc
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    zones, key = options["zones"], options["key"]
    plain = zones.startswith("file:/") and not zones.startswith("file://")
    filesystem, folder = pafs.FileSystem.from_uri(zones.replace("file:/", "file:///", 1) if plain else zones)
    part = f"{folder}/chunk={predicate}"
    if filesystem.get_file_info(part).type == pafs.FileType.NotFound:
        return
    files = [f.path for f in filesystem.get_file_info(pafs.FileSelector(part)) if f.path.endswith(".parquet")]
    controls = pa.concat_tables([pq.ParquetFile(filesystem.open_input_file(f)).read() for f in files])
    if not controls.num_rows:
        return
    groups: dict[str, list[int]] = {}
    for path, group in zip(controls.column("path").to_pylist(), controls.column("row_group").to_pylist()):
        groups.setdefault(path, []).append(group)
    first, beyond = controls.column("from")[0], controls.column("to")[0]
    names = schema.names if key in schema.names else [*schema.names, key]
    for path in sorted(groups):
        with open_parquet(path) as parquet:
            # One group at a time: a file's groups are never held together.
            for group in sorted(groups[path]):
                if not may_hold(parquet.metadata.row_group(group), filters):
                    continue
                for piece in parquet.iter_batches(int(options["batch_rows"]), row_groups=[group], columns=names):
                    values = piece.column(piece.schema.get_field_index(key))
                    inside = in_range(values, _as(first, values.type), _as(beyond, values.type), pc)
                    found = piece.filter(inside) if inside is not None else piece
                    if found.num_rows:
                        yield found


def _as(bound, kind: pa.DataType):
    return bound.cast(kind) if bound.is_valid else None


def in_range(values, first, beyond, pc):
    """Mask of first <= value < beyond as Spark orders values: NULL before all, NaN behind all; None where all are inside."""
    if first is None and beyond is None:
        return None
    floating = pa.types.is_floating(values.type)
    nan = pc.fill_null(pc.is_nan(values), False) if floating else None
    mask = None
    if first is not None:
        mask = pc.fill_null(pc.greater_equal(values, first), False)
        mask = pc.or_(mask, nan) if floating else mask
    if beyond is not None:
        below = pc.fill_null(pc.less(values, beyond), first is None)
        below = pc.and_(below, pc.invert(nan)) if floating else below
        mask = below if mask is None else pc.and_(mask, below)
    return mask


def sample_encoder(compression: str, rows: int, arrow: pa.Schema):
    """Rows of the first row groups of each file, at most so many, and the bytes they take when they are written anew with a codec."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            counts, sizes = [], []
            for path in batch.column("path").to_pylist():
                out, taken = pa.BufferOutputStream(), 0
                with open_parquet(path) as parquet, pq.ParquetWriter(out, arrow, compression=compression, write_statistics=False) as writer:
                    for piece in parquet.iter_batches(min(rows, 65_536), columns=arrow.names):
                        piece = piece.slice(0, rows - taken)
                        writer.write_batch(pa.RecordBatch.from_arrays([piece.column(f.name).cast(f.type) for f in arrow], schema=arrow))
                        taken += piece.num_rows
                        if taken >= rows:
                            break
                counts.append(taken)
                sizes.append(len(out.getvalue()))
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["rows", "bytes"])

    return read
