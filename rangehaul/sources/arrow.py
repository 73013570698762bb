"""Range reads that hand Arrow batches to Spark inside executor tasks.

`scan_row_groups` reads Parquet by physical ranges (row groups). `ArrowRangeSource` is the
extension point for a database: any function that turns a predicate into Arrow batches becomes
a Spark data source with one partition per range.
"""

from __future__ import annotations

import importlib
import json
import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

from rangehaul.sources.tasks import row_group_reader

# The data source class travels to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scan_row_groups(controls: DataFrame, schema: T.StructType, columns: Sequence[str] | None = None, batch_rows: int = 65_536, tasks: int | None = None) -> DataFrame:
    """Read the row groups named by control rows (path, row_group), each exactly once.

    Only control rows move between tasks; the data goes from file to Arrow batch to Spark.
    """
    wanted = T.StructType([schema[name] for name in (columns or schema.names)])
    read = row_group_reader(to_arrow_schema(wanted), batch_rows)
    # A fixed number of tasks: control rows are tiny, adaptive merging would put them in one task.
    count = tasks or 4 * controls.sparkSession.sparkContext.defaultParallelism
    return controls.select("path", "row_group").repartition(count, "path", "row_group").mapInArrow(read, wanted)


class RangePartition(InputPartition):
    """One key range."""

    def __init__(self, chunk: int, predicate: str):
        super().__init__(chunk)
        self.predicate = predicate


class ArrowRangeReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options = dict(options)
        self.arrow = to_arrow_schema(schema)

    def partitions(self) -> Sequence[InputPartition]:
        predicates = json.loads(self.options.get("predicates", '["1=1"]'))
        return [RangePartition(i, predicate) for i, predicate in enumerate(predicates)]

    def read(self, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        module, function = self.options["reader"].split(":")
        batches = getattr(importlib.import_module(module), function)
        yield from self._typed(batches(partition.predicate, self.options))

    def _typed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name).cast(f.type) for f in self.arrow], schema=self.arrow
            )


# Filters whose meaning is plain for a row group's statistics.
_COMPARED = {EqualTo: "=", LessThan: "<", LessThanOrEqual: "<=", GreaterThan: ">", GreaterThanOrEqual: ">="}


class PushedRangeReader(ArrowRangeReader):
    """Reader of a function (predicate, options, schema, filters) that may skip what no filter lets through.

    Filters (column, operator, value) are hints: Spark applies all of them again to the rows.
    """

    def __init__(self, options: dict[str, str], schema: T.StructType, batches: Callable):
        super().__init__(options, schema)
        self.batches = batches
        self.filters: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for known in filters:
            if len(known.attribute if hasattr(known, "attribute") else ()) == 1:
                column = known.attribute[0]
                if type(known) in _COMPARED:
                    self.filters.append((column, _COMPARED[type(known)], known.value))
                elif isinstance(known, (IsNull, IsNotNull)):
                    self.filters.append((column, "null" if isinstance(known, IsNull) else "notnull", None))
            yield known

    def read(self, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        yield from self._typed(self.batches(partition.predicate, self.options, self.arrow, self.filters))


class ArrowRangeSource(DataSource):
    """Data source `arrow_ranges`.

    Options: `reader` ("module:function", called inside tasks as function(predicate, options) and
    yielding Arrow record batches), `predicates` (JSON list), `ddl` (schema); all others are
    passed through to the reader. Credentials belong in the executors' environment.
    A subclass with `batches` set carries its function to the executors by value.
    """

    batches: Callable | None = None

    @classmethod
    def name(cls) -> str:
        return "arrow_ranges"

    def schema(self) -> str:
        return self.options["ddl"]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        batches = type(self).batches
        return ArrowRangeReader(self.options, schema) if batches is None else PushedRangeReader(self.options, schema, batches)


def read_arrow_ranges(spark: SparkSession, reader: str | Callable, predicates: Sequence[str], schema: T.StructType, pushdown: bool = False, **options: str) -> DataFrame:
    """Register the source and read the ranges of a plan.

    With `pushdown`, `reader` is a function (predicate, options, schema, filters) that travels by value and sees the filters of the query; the
    session's filter pushdown for Python sources is switched on for it.
    """
    if pushdown:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        spark.dataSource.register(type("PushedRangeSource", (ArrowRangeSource,), {"batches": staticmethod(reader)}))
        reader = "pushed"
    else:
        spark.dataSource.register(ArrowRangeSource)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return (
        spark.read.format("arrow_ranges")
        .options(reader=reader, predicates=json.dumps(list(predicates)), ddl=ddl, **options)
        .load()
    )
