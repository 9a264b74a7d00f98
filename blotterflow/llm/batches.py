"""Arrow batches of texts: bounded pieces, their bytes, and columns added to them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: The name under which functions on pieces find the text.
TEXT = "_llm_text"
#: Text bytes worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 21


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 places where its texts begin; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype=wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(places) or places[0] == places[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, or one row."""
    _, places = text_bytes(batch.column(text))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(places, places[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at)
        at = end


def strings(values: Sequence[str | None]) -> pa.Array:
    return pa.array(values, pa.string())


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns of these names, in any case."""
    gone = {n.lower() for n in names}
    return df.select(*[df[c] for c in df.columns if c.lower() not in gone])


def hidden(df: DataFrame) -> DataFrame:
    """``df`` with names no operator gives; ``toDF`` with the old names undoes it."""
    return df.toDF(*[f"_llm_given_{i}" for i in range(len(df.columns))])


def append_columns(
    df: DataFrame,
    text: str,
    fields: Sequence[StructField],
    build: Callable[[], Callable[[pa.RecordBatch], Sequence[pa.Array]]],
    drop: Sequence[str] = (),
) -> DataFrame:
    """``df`` with columns that Python works out, piece by piece.

    ``build()`` runs once per task and returns the function from a piece, whose text
    column is named ``TEXT``, to its new columns, and what to call at the task's end, if
    it holds memory, as the function's ``close``. A column of ``df`` that has the name
    of a new one is replaced by it; columns in ``drop`` are read but not returned.
    """
    gone = {f.name.lower() for f in fields} | {d.lower() for d in drop}
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in gone]
    schema = StructType([df.schema[i] for i in kept] + list(fields))
    names = [f.name for f in schema]
    at = df.columns.index(text)

    def run(batches):
        work = build()
        for batch in batches:
            given = [TEXT if i == at else n for i, n in enumerate(batch.schema.names)]
            for piece in pieces(batch.rename_columns(given), TEXT):
                columns = [piece.column(i) for i in kept] + list(work(piece))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        getattr(work, "close", lambda: None)()
        pa.default_memory_pool().release_unused()  # workers live on between stages

    return df.mapInArrow(run, schema)
