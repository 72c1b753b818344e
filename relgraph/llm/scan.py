"""Running a per-document helper over a documents frame, batch by batch.

Operators of this package that read whole texts in Python use
:func:`scan_texts`: Spark deals out the rows, each task passes Arrow batches
through the helper and nothing is kept between documents but read-only tables.

Common rules of these operators:

* one output row per input row, repeated rows and null ids included;
* a null text is treated as the operator states (mostly as an empty one);
* an input column with the name of an output column (in any case) is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words of licence, PII and benchmark matching: A-Z lower-cased, every other
#: ASCII character that is no letter or digit separates.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: UTF-8 bytes that continue a character.
CONTINUATION = bytes(range(0x80, 0xC0))
#: Most bytes of text that one Arrow batch is cut into before a helper sees it.
SLICE_BYTES = 8 << 20


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text."""
    return text.translate(_PLAIN).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text."""
    return text.split()


def code_points(text: bytes) -> int:
    return len(text.translate(None, CONTINUATION))


def read_documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept_columns(df: DataFrame, new: Iterable[str], keep: Sequence[str] | None) -> list[str]:
    """Columns to carry along: ``keep`` (default all) without those that the new ones replace."""
    taken = {name.lower() for name in new}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]


def hidden(carried: Sequence[str]) -> tuple[list[str], list[Column], list[Column]]:
    """(names, columns under these names, and back): carried columns that no working column can clash with."""
    names = [f"__c{i}" for i in range(len(carried))]
    return names, [F.col(f"`{c}`").alias(n) for c, n in zip(carried, names, strict=True)], [F.col(n).alias(c) for c, n in zip(carried, names, strict=True)]


def fresh(name: str, df: DataFrame) -> str:
    """The name with as many underscores behind it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def scan_texts(
    docs: DataFrame,
    fields: str,
    make: Callable[[], Callable[[list[bytes | None]], Sequence[Sequence]]],
    text_col: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Append columns computed from whole texts.

    ``fields`` is the DDL of the new columns.  ``make`` runs once per task and
    returns the helper, which gets a list of UTF-8 texts (None for null) and
    returns one sequence per new column.  ``keep`` names the carried columns.
    """
    new = StructType.fromDDL(fields)
    carried = kept_columns(docs, new.names, keep)
    source = docs.select(*[docs[f"`{c}`"] for c in carried], docs[f"`{text_col}`"].alias(fresh("__scan_text", docs)))
    schema = StructType([docs.schema[c] for c in carried] + list(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        helper = make()
        kinds = [to_arrow_type(f.dataType) for f in new]
        for whole in batches:
            for batch in sliced(whole):
                texts = batch.column(len(carried)).cast(pa.binary()).to_pylist()
                results = helper(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(len(carried))]
                    + [pa.array(r, type=k) for r, k in zip(results, kinds, strict=True)],
                    names=[*carried, *new.names],
                )

    return source.mapInArrow(run, schema)


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about SLICE_BYTES each, never less than one row."""
    if batch.num_rows == 0:
        return
    rows = max(1, math.ceil(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def columns_of(rows: Sequence[Sequence], width: int) -> list[list]:
    """Rows of a helper turned into its columns."""
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(width)]
