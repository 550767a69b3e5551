"""What the operators share: words of a text, batches of rows, learned groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: A-Z to a-z, all other bytes as they are; safe on UTF-8, where these bytes are only letters.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; ``bytes.split`` cuts at just these bytes."""
    return text.translate(LOWER).split()


def as_bytes(col: str | Column) -> Column:
    """UTF-8 of a text column, empty for null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def fields_of(df: DataFrame, *names: str) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType, True) for n in names]


def map_rows(
    df: DataFrame, fields: Sequence[T.StructField], worker: Callable[[Iterator[dict[str, list]]], Iterable[dict]]
) -> DataFrame:
    """``mapInArrow`` with columns as lists: the worker gets and yields ``{column: values}`` per batch."""
    types = [(f.name, to_arrow_type(f.dataType)) for f in fields]
    schema = pa.schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (dict(zip(b.schema.names, (c.to_pylist() for c in b.columns))) for b in batches)
        for out in worker(columns):
            arrays = [v if isinstance(v := out[n], pa.Array) else pa.array(v, t) for n, t in types]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, T.StructType(list(fields)))
