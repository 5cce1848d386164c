"""User code that runs per partition: opened once, called per row, closed at the end."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


class RowHandler(Protocol):
    """A context manager that turns one row into any number of rows."""

    def __enter__(self) -> "RowHandler": ...

    def rows(self, row: dict[str, Any]) -> Iterable[dict[str, Any]] | None: ...

    def __exit__(self, *error: object) -> None: ...


def map_rows(df: DataFrame, make_handler: Callable[[], RowHandler], schema: StructType) -> DataFrame:
    """Run a handler over each partition and return its rows.

    ``make_handler`` is called on the executor, once per partition, so connections and models
    live where they are used. Rows go out batch by batch; no partition is held in memory.
    """
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with make_handler() as handler:
            for batch in batches:
                made = [out for row in batch.to_pylist() for out in handler.rows(row) or ()]
                yield pa.RecordBatch.from_pylist(made, schema=arrow_schema)

    return df.mapInArrow(run, schema)
