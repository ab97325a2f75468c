"""Functions of rows as columns: Arrow batches, of which only some rows at a time are Python's objects."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows, and bytes, that are Python's objects at a time. A row that is larger is alone.
MOST_ROWS, MOST_BYTES = 64, 1 << 20


def slices(columns: list[pa.Array]) -> list[tuple[int, int]]:
    """(first row, rows) of parts that are bounded in rows and bytes; a part over the bound is halved."""
    todo = [(at, min(MOST_ROWS, len(columns[0]) - at)) for at in range(0, len(columns[0]), MOST_ROWS)][::-1]
    out = []
    while todo:
        at, n = todo.pop()
        if n > 1 and sum(c.slice(at, n).nbytes for c in columns) > MOST_BYTES:
            todo += [(at + n // 2, n - n // 2), (at, n // 2)]
        else:
            out.append((at, n))
    return out


def per_row(function: Callable, kind: T.DataType) -> Callable[..., Column]:
    """A column function of function's value for each row; nulls are given as None."""
    arrow = to_arrow_type(kind)

    def run(*columns: pa.Array) -> pa.Array:
        parts = [pa.array([function(*row) for row in zip(*(c.slice(at, n).to_pylist() for c in columns))], arrow) for at, n in slices(list(columns))]
        done = pa.concat_arrays(parts) if parts else pa.array([], arrow)
        del parts
        pa.default_memory_pool().release_unused()
        return done

    run.__annotations__ = {"columns": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, kind)
