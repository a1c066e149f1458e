"""Helpers the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from eventflow.sources.checkpoints import shared_dir

#: Rows handled at once inside a task; bounds what a Python worker holds beside its tables.
SLICE = 1000
#: Bytes of a slim table's inputs for each of its files.
FILE_BYTES = 256 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(divisor))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that df is made of, by their files' sizes; what is no file, such as local rows, counts as none."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 62)


def written(df: DataFrame, name: str, slim: bool = False, number: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors.

    Slim tables, which hold no more than what they are made of, are gathered first, as many tasks would leave as
    many tiny files: into a file for every FILE_BYTES of their inputs, and one per core at least. `number` names
    a column for a unique number of each row; it is given in the tasks that write, so that a task that is run
    again gives no other numbers than those that are read.
    """
    path = scratch(df.sparkSession, name)
    if slim:
        df = df.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // FILE_BYTES)))
    if number is not None:
        df = df.withColumn(number, F.monotonically_increasing_id())
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def arrow_batch(columns: dict[str, Any], schema: T.StructType) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        kind, values = to_arrow_type(field.dataType), columns[field.name]
        arrays.append(values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def append_columns(
    df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], dict[str, Any]]], fields: str
) -> DataFrame:
    """df with the columns of `fields`, computed batch by batch.

    `start` runs once per task and gives the function from a batch to the new columns. A new column
    takes the place of an input column of the same name in any letter case.
    """
    added = struct(fields)
    taken = {name.lower() for name in added.names}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    schema = T.StructType(kept + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for part in slices(batches):
            new = work(part)
            yield arrow_batch({f.name: part.column(f.name) for f in kept} | new, schema)

    return df.mapInArrow(run, schema)


class BoundedCache(dict):
    """A dict that starts over once it holds `limit` entries."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def add(self, items: dict) -> None:
        if len(self) + len(items) > self.limit:
            self.clear()
        if len(items) <= self.limit:
            self.update(items)
