"""What the operators share: clean input columns, Arrow plumbing, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.catalog.base import table  # noqa: F401
from sheafmill.session import materialise, scratch_path  # noqa: F401

#: White space of the contracts: space and U+0009 to U+000D.
SPACES = b" \t\n\x0b\x0c\r"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """The id and the text (null: empty) under fixed names, so that other columns cannot clash."""
    return docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        *[docs[c] for c in more],
    )


def id_type(docs: DataFrame, id_col: str = "doc_id") -> str:
    return docs.schema[id_col].dataType.simpleString()


def map_rows(
    df: DataFrame, columns: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]
) -> DataFrame:
    """Arrow batches through the function that `make` builds once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            if batch.num_rows:
                step = step or make()
                yield step(batch)

    return df.mapInArrow(run, columns)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The values of a text column as UTF-8, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def arrow_type(simple: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[simple]


def long_sum(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def only(docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of `docs` whose id is in `chosen`, with all columns; a null id equals a null id."""
    ids = chosen.select(F.col(id_col).alias("_chosen_id"))
    return docs.join(ids, docs[id_col].eqNullSafe(ids["_chosen_id"]), "left_semi")


def parts(data: bytes, cut: bytes = b" ", size: int = 1 << 22) -> Iterator[bytes]:
    """`data` in parts of some `size` bytes that begin at a `cut`, so that a very long text is never split at once."""
    at = 0
    while len(data) - at > size:
        end = data.find(cut, at + size)
        if end < 0:
            break
        yield data[at:end]
        at = end
    yield data[at:] if at else data
