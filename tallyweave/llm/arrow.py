"""Row functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def map_rows(df: DataFrame, rows: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """``rows(*columns)`` over each batch of ``df``: Python lists in, tuples out."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(rows(*(c.to_pylist() for c in batch.columns)))
            columns = list(zip(*out, strict=True)) or [()] * len(target)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(run, schema)
